"""Compare ways to build the history on many events, with and without a dominant purchase.

    python benchmarks/skew.py <folder of the given tables> <scratch folder> [copies]

Events are the given ones, repeated for `copies` groups of users; in the skewed variant every
third event belongs to one purchase. Prints seconds, bytes shuffled and the longest task of
each build, the last two from the event log Spark writes to the scratch folder.
"""

from __future__ import annotations

import os
import sys
import time
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from benchmarks.spark_log import log_metrics, session  # noqa: E402
from daybook.plans import build_history, build_history_literal  # noqa: E402
from daybook.sources import Feed  # noqa: E402
from registered import bindings  # noqa: E402


def enlarge(spark: SparkSession, sf: str, out: str, copies: int, skewed: bool) -> str:
    """Write `copies` times the given events, each copy with users of its own."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    many = many.repartition(32, F.xxhash64("event_id", "copy"))
    own = F.col("user_id") + F.col("copy") * 1_000_000
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(own) if skewed else own
    many = many.withColumns({"user_id": user, "event_id": F.col("event_id") * copies + F.col("copy")})
    path = f"{out}/{'skewed' if skewed else 'even'}"
    many = many.sortWithinPartitions(F.xxhash64("event_id", "user_id"))  # copies of an event lie apart
    many.drop("copy").write.parquet(f"{path}/events.parquet")
    return path


def by_purchase(feeds: list[Feed]) -> list[Feed]:
    """The alternative without pre-aggregation: one shuffle, all events of a purchase to one
    task. Cheaper where no purchase dominates, but a third of all events may end up there."""
    return [replace(feed, events=feed.events.repartition("purchase_id")) for feed in feeds]


def main(sf: str, scratch: str, copies: int = 100) -> None:
    spark = session(f"{scratch}/log", shuffle_partitions=64)
    seconds = {}
    for skewed in (False, True):
        path = enlarge(spark, sf, scratch, copies, skewed)
        feeds, ts = bindings.feeds(spark, path), bindings.RUN_TS
        builds = {
            "step by step": lambda: build_history_literal(feeds, ts),
            "build_history": lambda: build_history(feeds, ts),
            "by purchase at once": lambda: build_history(by_purchase(feeds), ts),
        }
        for name, build in builds.items():
            group = f"{'skewed' if skewed else 'even'} / {name}"
            spark.sparkContext.setJobGroup("warm-up", "warm-up")
            build().write.format("noop").mode("overwrite").save()
            spark.sparkContext.setJobGroup(group, group)
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds[group] = time.perf_counter() - start
    spark.stop()
    metrics = log_metrics(f"{scratch}/log")
    for group, took in seconds.items():
        written, longest = metrics[group]["shuffle_bytes"], metrics[group]["longest_task"]
        print(f"{group:30s} {took:7.1f} s  {written / 2**20:9.0f} MiB shuffled  longest task {longest:6.1f} s")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], *map(int, sys.argv[3:]))
