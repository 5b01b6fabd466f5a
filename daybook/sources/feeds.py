"""Change-event feeds: reading, typing, and setting aside events that cannot be placed."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.parsing import parse
from daybook.schemas import (
    EXTRA_INFO_PAYLOAD,
    PRODUCT_ITEM_PAYLOAD,
    PURCHASE,
    PURCHASE_PAYLOAD,
    Grain,
)

LENIENT_DATES = ("order_date", "release_date")


@dataclass(frozen=True)
class Feed:
    """One append-only event log and the columns it contributes to the history.

    `source` is its label in the provenance list, `flag` the name of its "touched" column.
    `tiebreak` columns decide between events of the same time; the payload itself is the
    last resort, so the winner never depends on the physical row order.
    """

    source: str
    flag: str
    log: DataFrame
    payload: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()
    #: Which rows of the log are this feed's events. Feeds of one log differ in nothing else, and
    #: operators read such a log once.
    picked: Column | None = None

    @property
    def events(self) -> DataFrame:
        return self.log if self.picked is None else self.log.where(self.picked)

    def where(self, condition: Column) -> Feed:
        return replace(self, log=self.log.where(condition))

    def since(self, keys: DataFrame, key: str, date: str) -> Feed:
        """Keep the events of the entities listed in `keys` from the day `since` on."""
        joined = self.log.join(keys, key).where(F.col(date) >= F.col("since")).drop("since")
        return replace(self, log=joined.select(*self.log.columns))

    def placed(self, grain: Grain = PURCHASE) -> DataFrame:
        """The events that name an entity, a day and a time."""
        return accepted(self.events, grain)

    def event(self, grain: Grain = PURCHASE) -> Column:
        """An event as one comparable value: time first, then tiebreak, then payload."""
        return F.struct(*dict.fromkeys((grain.time, *self.tiebreak, *self.payload)))


def purchase_feeds(
    purchase: DataFrame,
    product_item: DataFrame,
    extra_info: DataFrame,
    tiebreak: tuple[str, ...] = (),
) -> list[Feed]:
    """The three purchase feeds, in the order their names appear in `updated_sources`."""
    return [
        Feed("purchase", "has_purchase", purchase, PURCHASE_PAYLOAD, tiebreak),
        Feed("product_item", "has_product_item", product_item, PRODUCT_ITEM_PAYLOAD, tiebreak),
        Feed("purchase_extra_info", "has_extra_info", extra_info, EXTRA_INFO_PAYLOAD, tiebreak),
    ]


def picked_feeds(
    log: DataFrame, picks: Sequence[Column], tiebreak: tuple[str, ...] = ()
) -> list[Feed]:
    """The three purchase feeds out of one log that has all their columns: `picks` tell the rows of
    each, in the order of `purchase_feeds`. The log is then read once for all of them."""
    return [
        replace(feed, picked=pick)
        for feed, pick in zip(purchase_feeds(log, log, log, tiebreak), picks, strict=True)
    ]


def _required(grain: Grain) -> list[str]:
    return [grain.key, grain.date, grain.time]


def accepted(events: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    return reduce(
        lambda rows, name: rows.where(F.col(name).isNotNull()), _required(grain), events
    )


def quarantined(events: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """The rest of `accepted`, each row with the columns it lacks in `reject_reason`."""
    lacks = {name: F.col(name).isNull() for name in _required(grain)}
    reason = F.concat_ws(",", *[F.when(hit, F.lit(name)) for name, hit in lacks.items()])
    return events.withColumn("reject_reason", reason).where("reject_reason <> ''")


REJECTED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("source", "reject_reason", "event")]
)


def rejected_events(feeds: Sequence[Feed], grain: Grain = PURCHASE) -> DataFrame:
    """The events of all feeds that can't be placed: source, reason, and the event as JSON."""
    each = []
    for feed in feeds:
        columns = list(dict.fromkeys((*_required(grain), *feed.tiebreak, *feed.payload)))
        rows = quarantined(feed.events.select(*columns), grain)
        event = F.to_json(F.struct(*columns))
        each.append(rows.select(F.lit(feed.source).alias("source"), "reject_reason", event.alias("event")))
    return reduce(DataFrame.unionByName, each)


def normalize(
    raw: DataFrame, schema: T.StructType, lenient: Collection[str] = LENIENT_DATES
) -> DataFrame:
    """Bring a raw table to `schema`: text columns are parsed, typed ones cast."""
    given = {f.name: f.dataType for f in raw.schema}
    return raw.select(
        *[
            (
                parse(F.col(f.name), f.dataType, f.name in lenient)
                if isinstance(given[f.name], T.StringType)
                else F.col(f.name).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lenient: Collection[str] = LENIENT_DATES,
) -> DataFrame:
    """Read CSV files whose header names the columns of `schema`, in that order; another header
    fails, and so does a line with more or fewer fields, whichever of them a query reads. Fields
    arrive as text and are parsed by `normalize`: the reader's own typing would turn bad text into
    null without a word."""
    return normalize(_csv(spark, schema, "FAILFAST").csv(path), schema, lenient)


def _csv(spark: SparkSession, schema: T.StructType, mode: str, corrupt: str | None = None) -> DataFrameReader:
    fields = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", mode)
    if corrupt:
        fields = fields.add(corrupt, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    # the parser would count the fields of the columns it is asked for only
    return reader.schema(fields).option("columnPruning", False)


MALFORMED = T.StructType([T.StructField(name, T.StringType()) for name in ("reject_reason", "line")])


def split_csv(
    spark: SparkSession, path: str, schema: T.StructType, rejects: str, lenient: Collection[str] = LENIENT_DATES
) -> tuple[DataFrame, DataFrame]:
    """`read_csv` for files that may hold lines with more or fewer fields than the header: such a line does not
    fail the read. It is stored below `rejects`, with the reason, and left out of the rows.

    Returns the rows and the stored lines (reject_reason, line). The rows are read from the files when they
    are used; the lines were written by one pass of its own.
    """
    corrupt = "_corrupt_line"
    read = _csv(spark, schema, "PERMISSIVE", corrupt).csv(path)
    more = F.size(F.split(corrupt, ",")) > len(schema)
    # a line that breaks off has no last field; told by that column, as Spark reads no corrupt lines alone
    reason = F.when(more, "more fields").when(F.col(schema.names[-1]).isNull(), "fewer fields").otherwise("malformed")
    lines = read.where(F.col(corrupt).isNotNull()).select(reason.alias("reject_reason"), F.col(corrupt).alias("line"))
    lines.write.parquet(rejects)
    rows = read.where(F.col(corrupt).isNull()).select(*schema.names)
    return normalize(rows, schema, lenient), spark.read.schema(MALFORMED).parquet(rejects)
