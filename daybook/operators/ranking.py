"""Global and per-group top-k, with a full order so that ties never make results vary."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """The k rows with the largest `by`; each task keeps k rows, only those are merged."""
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(name) for name in tiebreak]]
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: str,
    by: str,
    k: int,
    tiebreak: Sequence[str],
    ties: Literal["break", "keep"] = "break",
) -> DataFrame:
    """The k best rows of each group; with ties="keep", every row that ties with the k-th too.

    Each task prunes its part of a group to k rows before the shuffle by group. Keeping ties
    ranks nothing: a row belongs to the answer if it is not below the k-th value of its group,
    so a group made of one long tie is filtered in place and never gathered in one window.
    """
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(name) for name in tiebreak]]
    best = (
        df.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
        .where(F.col("rn") <= k)
        .drop("rn")
    )
    if ties == "break":
        return best
    edge = best.groupBy(F.col(group).alias("edge_group")).agg(
        F.min(by).alias("edge_value"), F.count_if(F.col(by).isNull()).alias("edge_nulls")
    )
    # Nulls rank last: once one is among the k best, every row of the group is.
    reaches = (F.col("edge_nulls") > 0) | (F.col(by) >= F.col("edge_value"))
    return (
        df.join(edge, F.col(group).eqNullSafe(F.col("edge_group")))
        .where(reaches)
        .select(*df.columns)
    )
