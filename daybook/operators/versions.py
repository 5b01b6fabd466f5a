"""Picking one version per entity out of a history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.literals import date_literal
from daybook.schemas import PURCHASE, Grain


def as_of(
    history: DataFrame,
    cutoff: dt.date | str,
    columns: Sequence[str] | None = None,
    grain: Grain = PURCHASE,
) -> DataFrame:
    """Each entity as it was known on `cutoff`: its last row dated on or before that day.

    The date test prunes partitions of a stored history. The newest row is found by
    aggregation, so each task sends one row per entity. Name the columns you need; the
    others are then neither read nor shuffled.
    """
    keep = list(columns or history.columns)
    rest = [name for name in keep if name not in grain.day]
    return (
        history.where(F.col(grain.date) <= date_literal(cutoff))
        .groupBy(grain.key)
        .agg(F.max(F.struct(grain.date, *rest)).alias("version"))
        .select(grain.key, "version.*")
        .select(*keep)
    )


def as_of_each(
    history: DataFrame,
    requests: DataFrame,
    cutoff: str = "cutoff",
    columns: Sequence[str] | None = None,
    grain: Grain = PURCHASE,
) -> DataFrame:
    """The version known at each (entity, cutoff) of a table of requests, in one pass.

    Versions and requests are one timeline for each entity; a request sees the last version at or
    before it. Any number of cutoffs costs one shuffle and one window, where a join on the entity would
    pair every version with every request. A request that is made several times is answered once, so a
    timeline has at most two rows a day; one before the entity's first version gets no row.
    """
    keep = [name for name in (columns or history.columns) if name != grain.key]
    versions = history.select(
        grain.key, F.col(grain.date).alias("at"), F.lit(False).alias("asks"), F.struct(*keep).alias("version")
    )
    asked = requests.select(grain.key, F.col(cutoff).alias("at")).dropna().distinct().withColumn("asks", F.lit(True))
    known = F.last("version", ignorenulls=True).over(Window.partitionBy(grain.key).orderBy("at", "asks"))
    return (
        versions.unionByName(asked, allowMissingColumns=True)
        .withColumn("version", known)
        .where("asks AND version IS NOT NULL")
        .select(grain.key, F.col("at").alias(cutoff), "version.*")
    )
