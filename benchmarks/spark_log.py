"""A local session that keeps Spark's event log, and the figures read from that log."""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import SparkSession


def session(log_dir: str, shuffle_partitions: int) -> SparkSession:
    os.makedirs(log_dir)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{log_dir}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def log_metrics(log_dir: str) -> dict[str, dict[str, float]]:
    """Job group -> shuffle bytes written, shuffles that moved rows, longest task in seconds."""
    groups, stages = {}, {}
    for file in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(file):
            continue
        with open(file) as lines:
            events = [json.loads(line) for line in lines]
        for event in events:
            if event["Event"] == "SparkListenerJobStart":
                group = event["Properties"].get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    groups.setdefault(stage, group)
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                took = (event["Task Info"]["Finish Time"] - event["Task Info"]["Launch Time"]) / 1e3
                total, longest = stages.get(event["Stage ID"], (0, 0.0))
                stages[event["Stage ID"]] = (total + written, max(longest, took))
    found: dict[str, dict[str, float]] = {}
    for stage, (written, longest) in stages.items():
        sums = found.setdefault(
            groups.get(stage), {"shuffle_bytes": 0, "shuffles": 0, "longest_task": 0.0}
        )
        sums["shuffle_bytes"] += written
        sums["shuffles"] += written > 0
        sums["longest_task"] = max(sums["longest_task"], longest)
    return found
