"""Storing a history: layout, publishing behind the gate, table definition, CSV export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.plans.quality import gate, row_counts, run_checks
from daybook.schemas import HISTORY, ITEM_KEY, PURCHASE, Grain
from daybook.sources.feeds import REJECTED, Feed, rejected_events


def write_history(
    history: DataFrame, path: str, grain: Grain = PURCHASE, files_per_day: int = 16, overwrite_days: bool = False,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Write one folder per day, rows sorted by entity. An existing path is refused, or, with
    `overwrite_days`, the folders of just the days that have rows are replaced.

    A hash of the entity deals each day to `files_per_day` tasks, so the rows are computed once
    (ranges would be sampled first) and no day is one task's work. Set it to the bytes of
    the largest day by about 256 MB; small days do not get more files than there are tasks.
    Files are sorted by entity and carry a Bloom filter of it, so a point lookup skips almost all row
    groups. `observed` counts the rows in the pass that writes them, in its last stage, so that a task that
    runs twice counts once.
    """
    slot = F.pmod(F.xxhash64(grain.key), F.lit(files_per_day))
    rows = history.repartition(grain.date, slot).sortWithinPartitions(grain.date, grain.key)
    if observed:
        rows = rows.observe(observed[0], *observed[1])
    writer = rows.write.option(f"parquet.bloom.filter.enabled#{grain.key}", True)
    if overwrite_days:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(grain.date).parquet(path)


def read_history(spark: SparkSession, path: str, schema: T.StructType = HISTORY) -> DataFrame:
    """Read it back typed by contract and in contract order (partition columns come last in
    the files)."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _point(view: str, path: str, stored: DataFrame) -> None:
    """Let the view read the path."""
    query = f"SELECT {', '.join(stored.columns)} FROM parquet.`{path}`"
    if stored.isEmpty():
        # Without rows there are no files to take the columns from.
        kinds = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in stored.schema]
        query = f"SELECT {', '.join(kinds)} WHERE false"
    stored.sparkSession.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")


def publish(
    history: DataFrame,
    root: str,
    version: str,
    view: str,
    run_date: dt.date | str,
    now: dt.datetime,
    grain: Grain = PURCHASE,
    feeds: Sequence[Feed] = (),
) -> DataFrame:
    """Full load: write a new version, check it, then point the views at it. The checks of single rows are
    counted in the writing pass; those of keys read the keys of what was written.

    `<view>` reads the whole history by day, `<view>_current` a table of each entity's newest row,
    and, if the feeds are given, `<view>_rejected` the events that they could not place.

    The history is computed once. A failed gate raises and leaves the views on the old version;
    readers never see a half-written one. `version` must be new. Returns the report.
    """
    spark = history.sparkSession
    path = f"{root}/{version}"
    seen = Observation()
    write_history(history, path, grain, observed=(seen, row_counts(run_date, now)))
    stored = read_history(spark, path, T.StructType([HISTORY[name] for name in history.columns]))
    report = gate(run_checks(stored, run_date, now, grain, seen.get))
    newest = stored.where("is_current").repartition(grain.key).sortWithinPartitions(grain.key)
    newest.write.parquet(f"{path}-current")
    _point(view, path, stored)
    _point(f"{view}_current", f"{path}-current", read_history(spark, f"{path}-current", stored.schema))
    if feeds:
        rejected_events(feeds, grain).write.parquet(f"{path}-rejected")
        _point(f"{view}_rejected", f"{path}-rejected", read_history(spark, f"{path}-rejected", REJECTED))
    return report


def write_items(
    table: DataFrame, path: str, by: str = "prod_item_partition", key: str = "prod_item_id", files: int = 16
) -> None:
    """Write a current table (purchases or items) in folders by its item partition, so that a
    report on some partitions reads those folders of both sides only.

    A hash of the item deals each folder to `files` tasks, so few folders are not few tasks.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(files))
    table.repartition(by, slot).write.partitionBy(by).parquet(path)


def save_colocated(table: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """Store a current table (purchases or items) as catalog table `name`, bucketed and sorted by the item key.

    Two tables with the same buckets are joined on that key, and counted by it before, without a
    shuffle of either. Rows are dealt to buckets first, so each is one file. Set `buckets` to the bytes of
    the greater table by about 256 MB. A hot item makes one bucket large: its rows are counted in one task, in
    constant memory.
    """
    dealt = table.repartition(buckets, *ITEM_KEY)
    dealt.write.bucketBy(buckets, *ITEM_KEY).sortBy(*ITEM_KEY).option("path", path).saveAsTable(name)
    return table.sparkSession.table(name)


def create_history_table(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    schema: T.StructType = HISTORY,
    partition_by: Sequence[str] = (PURCHASE.date,),
) -> None:
    """Define the history as a catalog table, partitioned by day. Parquet enforces neither
    NOT NULL nor uniqueness; the gate checks both."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}){place}"
    )


def export_csv(df: DataFrame, path: str) -> None:
    """Write any frame as CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
