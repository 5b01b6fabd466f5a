"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised at approximate quantiles of its values (of a text: of its first eight bytes
as a number, which keeps their order). Rows are sorted by the index of their cell on the Hilbert curve,
and the order is cut into runs of equal length, so rows of one shard lie close together in every
dimension and minima and maxima of its files exclude most of them for a filter on any one.

The law is `rows`: shards differ by at most one row, whatever the hot values are. Ties of the curve are
ordered by text checksum, size and id; equal rows in any order, their places differ.

Defined results: null and NaN dimension values go to the lowest cell, null texts have no bytes and
checksum 0, rows that repeat each get a place, an empty table gives no rows, with fewer rows than shards
some shards stay empty, further columns are not read. Dimensions are numbers, texts, dates or times; others, and more
than 63 bits of all dimensions together, raise ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from daybook.llm.scratch import partitions, written

SHARDS = 24
BITS = 5


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of cell numbers below 2**bits.

    Gray code is undone from the highest bit down: each level's reflection or exchange is applied to
    the lower bits, then the bits of all dimensions are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = (x[i] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flips
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


def _number(frame: DataFrame, name: str) -> Column:
    kind = frame.schema[name].dataType
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(F.encode(name, "UTF-8"), 1, 8)), 16, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, NumericType):
        return F.nanvl(F.col(name).cast("double"), F.lit(None))
    if not isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"{name} is neither a number, a text, a date nor a time")
    return F.unix_timestamp(F.col(name).cast("timestamp")).cast("double")


def shards(frame: DataFrame, dimensions: list[str], id_column: str = "doc_id",
           text_column: str = "text", count: int = SHARDS, bits: int = BITS) -> DataFrame:
    """id, size (UTF-8 bytes plus 8), text_crc32, curve, shard and slot of each row."""
    if bits * len(dimensions) > 63:
        raise ValueError(f"{len(dimensions)} dimensions of {bits} bits are more than 63 bits")
    spark = frame.sparkSession
    names = [f"d{i}" for i in range(len(dimensions))]
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = written(
        frame.select(
            F.col(id_column).alias("id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            *[_number(frame, d).alias(n) for d, n in zip(dimensions, names)],
        ),
        "shard-rows",
    )
    width = 1 << bits
    found = rows.approxQuantile(names, [i / width for i in range(1, width)], 1 / (4 * width))
    cuts = [np.unique(np.array(x, float)) for x in found]
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [
                np.searchsorted(c, batch.column(n).cast(pa.float64()).fill_null(-np.inf).to_numpy(zero_copy_only=False), side="right")
                for c, n in zip(cuts, names)
            ]
            curve = hilbert(np.column_stack(cells), bits) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("size"), batch.column("text_crc32"), pa.array(curve)],
                ["id", "size", "text_crc32", "curve"],
            )

    placed = rows.mapInArrow(place, f"id {kind}, size long, text_crc32 long, curve long")
    order = ["curve", "text_crc32", "size", "id"]
    # one job, so that a row's partition and place in it belong to the same cut
    ordered = written(
        placed.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "shard-order",
    )
    part = F.shiftright("at", 33).cast("int")
    sizes = {r[0]: r[1] for r in ordered.groupBy(part.alias("part")).count().collect()}
    offsets, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(p, 0)
    starts = F.from_json(F.lit(json.dumps(offsets or [0])), "array<bigint>")  # folds to one literal
    rank = F.element_at(starts, part + 1) + F.col("at").bitwiseAND((1 << 33) - 1)
    shard = F.expr(f"CAST((rank * {count}) DIV {max(1, total)} AS INT)")
    first = F.expr(f"(CAST(shard AS BIGINT) * {max(1, total)} + {count - 1}) DIV {count}")
    return (
        ordered.withColumn("rank", rank)
        .withColumn("shard", shard)
        .withColumn("slot", F.col("rank") - first)
        .select(F.col("id").alias(id_column), "size", "text_crc32", "curve", "shard", "slot")
    )


def write_shards(frame: DataFrame, path: str, dimensions: list[str], id_column: str = "doc_id",
                 text_column: str = "text", count: int = SHARDS, bits: int = BITS) -> None:
    """Writes the rows below `path`/shard=N, in curve order. Ids must be unique here."""
    places = shards(frame, dimensions, id_column, text_column, count, bits)
    whole = frame.join(places.select(id_column, "shard", "slot"), id_column)
    (
        whole.repartitionByRange(max(count, partitions(frame.sparkSession)), "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .drop("slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
