"""The small worked example: three feeds, two current tables, and the history they give."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from daybook import schemas as s
from daybook.sources import Feed, purchase_feeds

RUN_TS = dt.datetime(2023, 7, 20, 6, 0, 0, 123456)
NOW = dt.datetime(2023, 7, 20, 6, 10, 0)
RUN_DATE = dt.date(2023, 7, 20)


def day(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def clock(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


_CAST = {s.DATE: day, s.CLOCK: clock, s.MONEY: money}


def frame(spark: SparkSession, schema, rows) -> DataFrame:
    """Rows of plain values; dates and times as text."""
    cast = [_CAST.get(f.dataType, lambda v: v) for f in schema]
    return spark.createDataFrame([tuple(c(v) for c, v in zip(cast, r)) for r in rows], schema)


PURCHASE_ROWS = [
    ("2023-01-20 22:00:00", "2023-01-20", 55, 15947, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5),
    ("2023-01-26 00:01:00", "2023-01-26", 56, 369798, 746520, "2023-01-25", None, 963963, 2400, "INICIADA", 6, 0),
    ("2023-02-05 10:00:00", "2023-02-05", 55, 160001, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5),
    ("2023-02-26 03:00:00", "2023-02-26", 69, 160001, 18, "2023-02-26", "2023-02-28", 96967, 4000, "APROVADA", 7, 8),
    ("2023-07-15 09:00:00", "2023-07-15", 55, 160001, 5, "2023-01-20", "2023-03-01", 852852, 550, "APROVADA", 5, 5),
]
ITEM_ROWS = [
    ("2023-01-20 22:02:00", "2023-01-20", 55, 696969, 10, 50),
    ("2023-01-25 23:59:59", "2023-01-25", 56, 808080, 120, 2400),
    ("2023-02-26 03:00:00", "2023-02-26", 69, 373737, 2, 2000),
    ("2023-07-12 09:00:00", "2023-07-12", 55, 696969, 10, 55),
]
INFO_ROWS = [
    ("2023-01-23 00:05:00", "2023-01-23", 55, "nacional"),
    ("2023-01-25 23:59:59", "2023-01-25", 56, "internacional"),
    ("2023-02-28 01:10:00", "2023-02-28", 69, "nacional"),
    ("2023-03-12 07:00:00", "2023-03-12", 69, "internacional"),
]
PURCHASE_CURRENT_ROWS = [
    (55, 15947, 5, "2022-12-01", "2022-12-01", 852852, 5, 5, "APROVADA"),
    (56, 369798, 746520, "2022-12-25", "2022-12-25", 963963, 6, 0, "APROVADA"),
    (57, 147, 98736, "2021-07-03", "2021-07-03", 963963, 7, 6, "APROVADA"),
    (58, 986533, 6565, "2021-10-12", None, 200478, 8, 5, "INICIADA"),
]
ITEM_CURRENT_ROWS = [
    (1, 69, 5, 500, 5),
    (5, 69, 120, 1, 0),
    (98736, 37, 69, 25, 6),
    (3, 96, 369, 140, 5),
]

HISTORY_ROWS = [
    ("2023-01-20", 55, 15947, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5, 696969, 50, None, False, True, "purchase,product_item"),
    ("2023-01-23", 55, 15947, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5, 696969, 50, "nacional", False, True, "purchase_extra_info"),
    ("2023-02-05", 55, 160001, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5, 696969, 50, "nacional", False, True, "purchase"),
    ("2023-07-12", 55, 160001, 5, "2023-01-20", "2023-01-20", 852852, 500, "APROVADA", 5, 5, 696969, 55, "nacional", False, True, "product_item"),
    ("2023-07-15", 55, 160001, 5, "2023-01-20", "2023-03-01", 852852, 550, "APROVADA", 5, 5, 696969, 55, "nacional", True, True, "purchase"),
    ("2023-01-25", 56, None, None, None, None, None, None, None, None, None, 808080, 2400, "internacional", False, False, "product_item,purchase_extra_info"),
    ("2023-01-26", 56, 369798, 746520, "2023-01-25", None, 963963, 2400, "INICIADA", 6, 0, 808080, 2400, "internacional", True, False, "purchase"),
    ("2023-02-26", 69, 160001, 18, "2023-02-26", "2023-02-28", 96967, 4000, "APROVADA", 7, 8, 373737, 2000, None, False, True, "purchase,product_item"),
    ("2023-02-28", 69, 160001, 18, "2023-02-26", "2023-02-28", 96967, 4000, "APROVADA", 7, 8, 373737, 2000, "nacional", False, True, "purchase_extra_info"),
    ("2023-03-12", 69, 160001, 18, "2023-02-26", "2023-02-28", 96967, 4000, "APROVADA", 7, 8, 373737, 2000, "internacional", True, True, "purchase_extra_info"),
]


def purchase(spark: SparkSession, *rows) -> DataFrame:
    return frame(spark, s.PURCHASE_EVENTS, rows)


def feeds(spark: SparkSession, p=PURCHASE_ROWS, pi=ITEM_ROWS, ei=INFO_ROWS) -> list[Feed]:
    return purchase_feeds(
        frame(spark, s.PURCHASE_EVENTS, p),
        frame(spark, s.PRODUCT_ITEM_EVENTS, pi),
        frame(spark, s.EXTRA_INFO_EVENTS, ei),
    )


def history(spark: SparkSession) -> DataFrame:
    stamp = "2023-07-20 06:00:00"
    return frame(spark, s.HISTORY, [(*row, stamp) for row in HISTORY_ROWS])


def event(when: str, pid, status="APROVADA", release="2024-01-01", buyer=1, total=10, day=None):
    """A purchase event with the columns the edge cases do not care about filled in."""
    return (when, day or when[:10], pid, buyer, 5, "2024-01-01", release, 9, total, status, 1, 1)


def random_events(seed, hot_share):
    rng = random.Random(seed)
    minute = iter(rng.sample(range(24 * 60), 600))

    def at():
        pid = 7 if rng.random() < hot_share else rng.randint(1, 12)
        date = f"2024-01-{rng.randint(1, 6):02d}"
        m = next(minute)
        return f"{date} {m // 60:02d}:{m % 60:02d}:00", date, pid

    def maybe(value):
        return None if rng.random() < 0.25 else value

    statuses = [*s.STATUS_DOMAIN, "APROVADA", "APROVADA"]
    p = [
        (*at(), maybe(rng.randint(1, 99)), maybe(rng.randint(1, 9)), maybe("2024-01-01"),
         maybe("2024-01-02"), maybe(3), maybe(rng.randint(1, 500)), maybe(rng.choice(statuses)), 1, 2)
        for _ in range(80)
    ]
    pi = [(*at(), maybe(rng.randint(1, 9)), 1, maybe(rng.randint(1, 500))) for _ in range(80)]
    ei = [(*at(), maybe(rng.choice(["nacional", "internacional"]))) for _ in range(80)]
    return p, pi, ei


def same(a: DataFrame, b: DataFrame) -> bool:
    """Equal as bags of rows, column by column name."""
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)

    def key(row):
        return [(value is not None, str(value)) for value in row]

    left, right = (sorted((tuple(r) for r in df.select(columns).collect()), key=key) for df in (a, b))
    assert left == right
    return True
