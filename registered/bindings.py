"""How the given tables stand in for the purchase model.

events     -> one log with the three change-event feeds; a user is a purchase, k is the number in `props`
lineitem   -> the current purchase table
part       -> the current product-item table
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import in_year
from daybook.schemas import MONEY, PURCHASE_EVENTS
from daybook.sources import Feed, load_table, picked_feeds

# Fixed values shared with the oracle SQL.
RUN_TS = dt.datetime(2024, 2, 1, 6, 30, 0)
NOW = dt.datetime(2024, 2, 1, 7, 0, 0)
RUN_DATE = dt.date(2024, 2, 1)
CUTOFF = dt.date(2024, 1, 15)
MONTH = dt.date(2024, 1, 1)
YEAR = 1998
PURCHASE_ID = 55
ITEM_PARTITION = 6
VERSION_COLUMNS = ["transaction_date", "buyer_id", "purchase_status", "purchase_value", "subsidiary", "is_gmv_eligible"]


def _number() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("long")


def event_log(events: DataFrame) -> DataFrame:
    """All events with the columns of all feeds; each feed picks its rows.

    purchase, signup -> purchase events      error -> a purchase event that only cancels
    view             -> product-item events  click -> extra-info events
    """
    k, day, kind = _number(), F.to_date("ts"), F.col("event_type")
    bought = kind.isin("purchase", "signup")
    status = (
        F.when(kind == "error", "CANCELADA")
        .when(k % 4 <= 1, "APROVADA")
        .when(k % 4 == 2, "CANCELADA")
        .otherwise("INICIADA")
    )
    amount = F.col("value").cast(MONEY)
    payload = {
        "buyer_id": F.when(bought, k),
        "prod_item_id": F.when(bought, k + 1000),
        "order_date": F.when(bought, day),
        "release_date": F.when(bought & (k % 5 != 0), day),
        "producer_id": F.when(bought, F.col("user_id") % 20),
        "purchase_total_value": F.when(bought, amount),
        "purchase_status": status,
        "purchase_partition": F.when(bought, F.col("user_id") % 10),
        "prod_item_partition": F.when(bought, k % 10),
        "product_id": k,
        "purchase_value": amount,
        "subsidiary": F.when(k % 2 == 0, "nacional").otherwise("internacional"),
    }
    return events.select(
        F.col("ts").alias("transaction_datetime"),
        day.alias("transaction_date"),
        F.col("user_id").alias("purchase_id"),
        "event_id",
        "event_type",
        *[value.alias(name) for name, value in payload.items()],
    )


#: The event types that each feed picks from the log, in the order of `purchase_feeds`.
PICKED = (("purchase", "signup", "error"), ("view",), ("click",))


def feeds(spark: SparkSession, sf: str) -> list[Feed]:
    return feeds_of(event_log(load_table(spark, sf, "events")))


def feeds_of(log: DataFrame) -> list[Feed]:
    return picked_feeds(log, [F.col("event_type").isin(*kinds) for kinds in PICKED], ("event_id",))


def purchase_events(spark: SparkSession, sf: str) -> DataFrame:
    return feeds(spark, sf)[0].events.select(*PURCHASE_EVENTS.names, "event_id")


def raw_purchase_text(spark: SparkSession, sf: str) -> DataFrame:
    """The purchase feed as text, the way a CSV delivers it, with blank and unreadable dates in
    the two columns that tolerate them."""
    k = F.col("buyer_id")
    day = F.col("order_date").cast("string")
    feed = purchase_events(spark, sf).withColumns(
        {
            "order_date": F.when(k % 7 == 0, "31/31/2024").otherwise(day),
            "release_date": F.when(k % 5 == 0, "").when(k % 5 == 1, "x").otherwise(day),
        }
    )
    columns = [name for name in feed.columns if name != "event_id"]
    return feed.select(*[F.col(name).cast("string").alias(name) for name in columns])


def damaged_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The raw feed with last fields that, written without quotes, make a line with a field too many, or put
    a line of one field behind theirs."""
    raw = raw_purchase_text(spark, sf).select(*PURCHASE_EVENTS.names)
    k, last = F.col("buyer_id").cast("long"), raw.columns[-1]
    more, fewer = F.concat(last, F.lit(",x")), F.concat(last, F.lit("\nbroken off"))
    return raw.withColumn(last, F.when(k % 11 == 3, more).when(k % 13 == 5, fewer).otherwise(F.col(last)))


def unplaced(log: DataFrame) -> DataFrame:
    """The log with keys and times of purchase events blanked out here and there."""
    k = F.col("buyer_id")

    def kept(name: str, every: int) -> Column:
        return F.when(F.coalesce(k % every != 0, F.lit(True)), F.col(name))

    return log.withColumns(
        {
            "purchase_id": kept("purchase_id", 11),
            "transaction_date": kept("transaction_date", 13),
            "transaction_datetime": kept("transaction_datetime", 17),
        }
    )


def unplaced_events(spark: SparkSession, sf: str) -> DataFrame:
    return unplaced(purchase_events(spark, sf))


def purchases(spark: SparkSession, sf: str, year: int | None = None) -> DataFrame:
    """The current purchases; with `year` only those released in it. That test is put on the column
    of the table, so that it reaches the scan: `release_date` is a computed one here."""
    paid = F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate"))
    status = F.when(F.col("l_linestatus") == "F", "APROVADA").otherwise("INICIADA")
    lines = load_table(spark, sf, "lineitem")
    if year is not None:
        lines = lines.where(in_year("l_shipdate", year)).where(F.col("l_returnflag") != "R")
    return lines.select(
        F.col("l_suppkey").alias("producer_id"),
        F.col("l_partkey").alias("prod_item_id"),
        (F.col("l_partkey") % 10).alias("prod_item_partition"),
        paid.alias("release_date"),
        status.alias("purchase_status"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "part").select(
        F.col("p_partkey").alias("prod_item_id"),
        (F.col("p_partkey") % 10).alias("prod_item_partition"),
        F.col("p_size").cast("long").alias("product_id"),
        F.col("p_retailprice").cast(MONEY).alias("purchase_value"),
    )


# Faults planted into a sound history so that every check has something to count. The texts
# are valid in Spark SQL and in the oracle's dialect.
PLANTED = {
    "transaction_date": "CASE WHEN day(transaction_date) = 6 THEN DATE '2030-01-01'"
    " WHEN day(transaction_date) = 9 AND purchase_id % 10 = 1 THEN NULL"
    " ELSE transaction_date END",
    "purchase_id": "CASE WHEN day(transaction_date) = 8 THEN NULL ELSE purchase_id END",
    "buyer_id": "CASE WHEN is_current AND purchase_id % 10 = 2 THEN NULL ELSE buyer_id END",
    "order_date": "CASE WHEN day(transaction_date) = 12 THEN DATE '2024-01-13'"
    " ELSE order_date END",
    "release_date": "CASE WHEN day(transaction_date) = 13 THEN DATE '2023-12-31'"
    " WHEN day(transaction_date) = 15 AND purchase_id % 2 = 0 THEN NULL ELSE release_date END",
    "purchase_total_value": "CASE WHEN day(transaction_date) = 10 THEN CAST(-1 AS DECIMAL(18,2))"
    " WHEN day(transaction_date) = 18 THEN CAST(1000000.01 AS DECIMAL(18,2))"
    " ELSE purchase_total_value END",
    "purchase_status": "CASE WHEN is_current AND purchase_id % 10 = 3 THEN NULL"
    " WHEN day(transaction_date) = 14 THEN 'DESCONHECIDA' ELSE purchase_status END",
    "purchase_value": "CASE WHEN day(transaction_date) = 11 THEN CAST(-1 AS DECIMAL(18,2))"
    " ELSE purchase_value END",
    "is_current": "CASE WHEN purchase_id % 10 = 4 THEN FALSE ELSE is_current END",
    "is_gmv_eligible": "CASE WHEN day(transaction_date) = 15 THEN TRUE ELSE is_gmv_eligible END",
    "updated_sources": "CASE WHEN day(transaction_date) = 19 THEN ''"
    " WHEN day(transaction_date) = 20 THEN NULL ELSE updated_sources END",
    "etl_loaded_at": "CASE WHEN day(transaction_date) = 16 THEN NULL"
    " WHEN day(transaction_date) = 17 THEN {clock} '2024-02-01 05:59:59' ELSE etl_loaded_at END",
}
COPIED = "day(transaction_date) = 5"


def plant(history: DataFrame) -> DataFrame:
    """The history with faults; rows that are to occur twice are doubled in the same pass."""
    copies = F.expr(f"explode(sequence(1, IF({COPIED}, 2, 1)))").alias("copy")
    doubled = history.select("*", copies)
    return doubled.select(
        *[
            F.expr(PLANTED.get(name, name).format(clock="TIMESTAMP_NTZ")).alias(name)
            for name in history.columns
        ]
    )
