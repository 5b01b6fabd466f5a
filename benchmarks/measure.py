"""Seconds, shuffles and bytes shuffled of every registered query, as a Markdown table.

    python benchmarks/measure.py <folder of the given tables> <scratch folder>
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from benchmarks.spark_log import log_metrics, session  # noqa: E402
from registered.queries import QUERIES  # noqa: E402


def main(sf: str, scratch: str) -> None:
    spark = session(f"{scratch}/log", shuffle_partitions=8)
    seconds = {}
    for run in ("warm-up", "timed"):
        for name, query in QUERIES.items():
            group = name if run == "timed" else run
            spark.sparkContext.setJobGroup(group, group)
            start = time.perf_counter()
            query(spark, sf).write.format("noop").mode("overwrite").save()
            seconds[name] = time.perf_counter() - start
    spark.stop()
    metrics = log_metrics(f"{scratch}/log")
    print("| query | seconds | shuffles | KiB shuffled |")
    print("|---|---:|---:|---:|")
    for name, took in seconds.items():
        found = metrics[name]
        print(f"| {name} | {took:.2f} | {found['shuffles']} | {found['shuffle_bytes'] / 1024:.0f} |")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
