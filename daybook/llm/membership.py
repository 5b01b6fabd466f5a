"""A Bloom filter of a table's keys: a broadcast of fixed size, whatever the table's.

It keeps rows without a partner out of a join's shuffle. With few keys almost nothing else passes;
with very many the filter is full and lets everything pass: then the join is as without it, and as exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.scratch import shared

BITS = 25


def _places(key: Column) -> tuple[Column, Column]:
    mask = F.lit((1 << BITS) - 1)
    hashed = F.xxhash64(key)
    return hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 64 - BITS)


def may_be_in(keys: DataFrame, name: str):
    """A function of a column: false only where the column's value is no value of `keys`' column `name`."""
    spark = keys.sparkSession
    bits = keys.select(F.explode(F.array(*_places(F.col(name)))).alias("bit"))
    words = (
        bits.groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("set"))
        .toArrow()
    )
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy()
    held = shared(spark, table)

    @F.pandas_udf("boolean")
    def both_set(one: pd.Series, two: pd.Series) -> pd.Series:
        hit = True
        for place in (one.to_numpy(), two.to_numpy()):
            hit = hit & ((held.value[place >> 6] >> (place & 63)) & 1 == 1)
        return pd.Series(hit)

    return lambda key: both_set(*_places(key))
