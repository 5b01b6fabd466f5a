"""Table contracts and fixed business values, stated once for the whole package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, TEXT, DATE, FLAG = T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
CLOCK = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(38, 2)

# Fixed values of the purchase domain.
APPROVED = "APROVADA"
STATUS_DOMAIN = ("APROVADA", "INICIADA", "CANCELADA", "REEMBOLSADA", "EXPIRADA")
VALUE_CEILING = 1_000_000
FRESHNESS_SECONDS = 3_600

# The item side of a purchase is addressed by its id and the lake partition it lives in.
ITEM_KEY = ["prod_item_id", "prod_item_partition"]


@dataclass(frozen=True)
class Grain:
    """Names of the columns that say whose event it is, on which day, and at what time."""

    key: str = "purchase_id"
    date: str = "transaction_date"
    time: str = "transaction_datetime"

    @property
    def day(self) -> list[str]:
        return [self.key, self.date]


PURCHASE = Grain()


def table(*columns: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in columns])


_EVENT = (("transaction_datetime", CLOCK), ("transaction_date", DATE), ("purchase_id", LONG))

PURCHASE_EVENTS = table(
    *_EVENT,
    ("buyer_id", LONG),
    ("prod_item_id", LONG),
    ("order_date", DATE),
    ("release_date", DATE),
    ("producer_id", LONG),
    ("purchase_total_value", MONEY),
    ("purchase_status", TEXT),
    ("purchase_partition", LONG),
    ("prod_item_partition", LONG),
)

PRODUCT_ITEM_EVENTS = table(
    *_EVENT, ("product_id", LONG), ("item_quantity", LONG), ("purchase_value", MONEY)
)

EXTRA_INFO_EVENTS = table(*_EVENT, ("subsidiary", TEXT))

PURCHASE_CURRENT = table(
    ("purchase_id", LONG),
    ("buyer_id", LONG),
    ("prod_item_id", LONG),
    ("order_date", DATE),
    ("release_date", DATE),
    ("producer_id", LONG),
    ("purchase_partition", LONG),
    ("prod_item_partition", LONG),
    ("purchase_status", TEXT),
)

PRODUCT_ITEM_CURRENT = table(
    ("prod_item_id", LONG),
    ("product_id", LONG),
    ("item_quantity", LONG),
    ("purchase_value", MONEY),
    ("prod_item_partition", LONG),
)

# Columns each feed contributes to the history; item_quantity stays behind in its feed.
PURCHASE_PAYLOAD = tuple(f.name for f in PURCHASE_EVENTS if f.name not in dict(_EVENT))
PRODUCT_ITEM_PAYLOAD = ("product_id", "purchase_value")
EXTRA_INFO_PAYLOAD = ("subsidiary",)

_PAYLOAD_TYPES = {
    f.name: f.dataType
    for schema in (PURCHASE_EVENTS, PRODUCT_ITEM_EVENTS, EXTRA_INFO_EVENTS)
    for f in schema
}

HISTORY = table(
    ("transaction_date", DATE),
    ("purchase_id", LONG),
    *(
        (name, _PAYLOAD_TYPES[name])
        for name in (*PURCHASE_PAYLOAD, *PRODUCT_ITEM_PAYLOAD, *EXTRA_INFO_PAYLOAD)
    ),
    ("is_current", FLAG),
    ("is_gmv_eligible", FLAG),
    ("updated_sources", TEXT),
    ("etl_loaded_at", CLOCK),
    required=("transaction_date", "purchase_id", "is_current", "is_gmv_eligible", "etl_loaded_at"),
)

# What the day-by-day store keeps: a row never changes after its day is loaded, so the
# "is this the newest row" flag is worked out on read.
SNAPSHOT = T.StructType([f for f in HISTORY if f.name != "is_current"])

AUDIT_COLUMNS = [
    "transaction_date",
    "purchase_id",
    "release_date",
    "purchase_status",
    "purchase_value",
    "subsidiary",
    "is_gmv_eligible",
    "updated_sources",
    "is_current",
]
