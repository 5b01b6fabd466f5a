"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession


BATCH_BYTES = 4 << 20


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below `spark.checkpoint.dir`; where that is unset, below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, computed once and read back: what follows survives lost executors."""
    spark = frame.sparkSession
    path = folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_OPEN: list[list[Broadcast]] = []


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast of a value of bounded size; inside `released`, it is freed at its end."""
    made = spark.sparkContext.broadcast(value)
    if _OPEN:
        _OPEN[-1].append(made)
    return made


@contextmanager
def released():
    """Destroys the broadcasts made inside, so frames made inside must have been written by its end."""
    _OPEN.append([])
    try:
        yield
    finally:
        for made in _OPEN.pop():
            made.destroy()


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever the case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """The configured number of shuffle partitions, which grows with the input on a cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def reach(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package from where the driver did, and bounds the
    bytes of an Arrow batch, as rows are documents here.

    On a cluster the package is installed or shipped with --py-files as usual; a path that does not exist
    there changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in known:
        environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])
