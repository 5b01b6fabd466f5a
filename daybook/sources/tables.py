"""Named tables, file tables and the shared folder for written intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def register_views(**frames: DataFrame) -> None:
    """Make frames available to `spark.sql` under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach: below `spark.checkpoint.dir` or, where that is
    unset, below the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
