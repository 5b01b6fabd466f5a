"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint is the k smallest distinct hashes of a text's shingles, in ascending order, as base64
of little-endian 64-bit integers. A text with fewer distinct shingles has them all, and every figure
is exact; a text without words has the empty string. Sketches of parts merge into the sketch of the
whole. Estimated are resemblance (shared share of the union), containment (shared share of the first)
and the number of distinct shingles; the standard error of a resemblance is below 0.5 / sqrt(k).

Defined results: a null text counts as empty; two empty sketches resemble each other fully, an empty
and a filled one not at all; equal texts have equal fingerprints; rows that repeat stay rows of their
own; ids are taken for keys that hardly repeat: rows of one id, and those without one, are put in order by one task
(spilling), and cross the shuffle twice if they begin a run; a table without rows gives none; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import SLICE_BYTES, slices
from daybook.llm.scratch import partitions

K = 128
SHINGLE_WORDS = 5


def bottom(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    if len(hashes) > 8 * k:
        few = np.unique(np.partition(hashes, 4 * k)[: 4 * k])
        if len(few) >= k:
            return few[:k]
    return np.unique(hashes)[:k]


def bottoms(texts: pa.Array, k: int, size: int) -> list[np.ndarray]:
    hashes, offsets = W.shingles(texts, size)
    return [bottom(hashes[a:b], k) for a, b in zip(offsets[:-1], offsets[1:])]


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the k smallest of the union that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below k, else from the place of the k-th smallest hash."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / (float(sketch[-1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of a's shingles that b has too; 1 if a has none."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, shared / distinct(a, k))


def fingerprints(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 k: int = K, size: int = SHINGLE_WORDS) -> DataFrame:
    """id, fingerprint and estimated number of distinct shingles of each row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                own = bottoms(rows.column("text"), k, size)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array([encode(x) for x in own], pa.string()),
                     pa.array([distinct(x, k) for x in own], pa.float64())],
                    ["id", "fingerprint", "distinct_shingles"],
                )

    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    made = source.mapInArrow(run, f"id {kind}, fingerprint string, distinct_shingles double")
    return made.withColumnRenamed("id", id_column)


def merged(frame: DataFrame, key: str, k: int = K) -> DataFrame:
    """One fingerprint for each key from a table of (key, fingerprint).

    Hashes are cut to the k smallest of each key in every task before they are shuffled, so a hot key
    sends k values for each task, and a key's group holds at most tasks times k of them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = decode(value or "")
                held[name] = merge(held[name], own, k) if name in held else own[:k]
                if len(held) >= 20_000:
                    yield packed(held)
                    held = {}
        yield packed(held)

    def packed(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), key_type), pa.array(map(encode, held.values()), pa.string())],
            ["key", "fingerprint"],
        )

    source = frame.select(F.col(key).alias("key"), "fingerprint")
    kind = source.schema["key"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(kind)
    schema = f"key {kind.simpleString()}, fingerprint string"
    dealt = source.mapInArrow(cut, schema).repartition(partitions(frame.sparkSession), "key")
    whole = dealt.sortWithinPartitions("key").mapInArrow(_whole(k, packed), schema)
    return whole.withColumnRenamed("key", key)


def _whole(k: int, packed):
    """Merges rows that come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sketch = None, None
        for batch in batches:
            done: dict = {}
            for other, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if sketch is not None and other == name:
                    sketch = merge(sketch, decode(value), k)
                    continue
                if sketch is not None:
                    done[name] = sketch
                name, sketch = other, decode(value)
            yield packed(done)
        if sketch is not None:
            yield packed({name: sketch})

    return run


def with_followers(frame: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(bucket, copy, id, text), sorted within partitions so that each row's follower is the next.

    Ids are cut into runs at approximate quantiles. The first row of each run also goes, as a copy, to
    the end of the run before it (of the first run: to the last), so every row of copy 0 is followed by
    the row of the next greater id in its own bucket. Texts are shuffled once, and what the driver sees
    is one number for each run. Rows with null ids come first; equal ids are ordered by text.
    """
    spark = frame.sparkSession
    width = 4 * partitions(spark)
    rows = frame.select(F.col(id_column).cast("long").alias("id"),
                        F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ids = rows.select("id").where("id IS NOT NULL")
    shares = [i / width for i in range(1, width)]
    cuts = np.unique(np.array(ids.approxQuantile("id", shares, 1 / (4 * width)), np.int64))
    lowest = -(1 << 63)
    key = F.coalesce("id", F.lit(lowest))

    @F.pandas_udf("long")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right"))

    bucket = bucket_of(key)
    lowest_keys = rows.select(key.alias("key"), bucket.alias("bucket")).groupBy("bucket").agg(F.min("key"))
    firsts = sorted(tuple(r) for r in lowest_keys.collect())
    leads = np.array([x for _, x in firsts], np.int64)
    ends = np.roll(np.array([b for b, _ in firsts], np.int64), 1)

    @F.pandas_udf("long")
    def copied_to(key: pd.Series) -> pd.Series:
        """The bucket before, of ids that are the first of theirs; others have none."""
        at = np.minimum(np.searchsorted(leads, key.to_numpy()), len(leads) - 1)
        return pd.Series(np.where(leads[at] == key.to_numpy(), ends[at], -1))

    placed = rows.select(bucket.alias("own"), copied_to(key).alias("before"), "id", "text")
    own = F.struct(F.col("own").alias("bucket"), F.lit(0).alias("copy"))
    also = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("copy"))
    dealt = placed.select(
        F.explode(F.when(F.col("before") >= 0, F.array(own, also)).otherwise(F.array(own))).alias("at"), "id", "text"
    )
    return (
        dealt.select("at.bucket", "at.copy", "id", "text")
        .repartition(partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "copy", "id", "text")
    )


def _edited(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> list[bytes]:
    """For each text but the last: its last half replaced by the first as many of the next one."""
    places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    base = np.concatenate(([0], np.cumsum(chars)))
    out = []
    for i in range(len(chars) - 1):
        half = chars[i] // 2
        cut = places[base[i] + chars[i] - half]
        end = places[base[i + 1] + min(half, chars[i + 1])]
        out.append(data[offsets[i] : cut].tobytes() + data[offsets[i + 1] : end].tobytes())
    return out


def edited_fingerprints(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                        k: int = K, size: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprint of each text, of its text edited with the next document's, and their likeness.

    A text of n code points is edited by replacing its last floor(n / 2) ones with the first as many
    (or all) of the next document in ascending id; the first follows the last. A single document
    follows itself.
    """
    schema = (f"{id_column} long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                if held is not None:
                    rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
                # copied, so that it does not keep the whole batch
                last = rows.slice(rows.num_rows - 1).take(pa.array([0]))
                if rows.num_rows > 1:
                    yield made(rows)
                held = last

    def made(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows.column("text")
        data, offsets = W.buffers(texts)
        chars = W.code_points(data, offsets)
        edited = _edited(data, offsets, chars)
        sketches = bottoms(texts, k, size)
        changed = bottoms(pa.array(edited, pa.large_binary()), k, size)
        follows = rows.column("bucket").to_numpy()
        copy = rows.column("copy").to_numpy()
        emit = [i for i in range(len(edited)) if copy[i] == 0 and follows[i] == follows[i + 1]]
        columns = {
            id_column: rows.column("id").take(pa.array(emit, pa.int64())),
            "n_chars": pa.array(chars[emit], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(edited[i]).hexdigest() for i in emit], pa.string()),
            "fingerprint": pa.array([encode(sketches[i]) for i in emit], pa.string()),
            "edited_fingerprint": pa.array([encode(changed[i]) for i in emit], pa.string()),
            "near_edited": pa.array([resemblance(sketches[i], changed[i], k) for i in emit], pa.float64()),
            "near_next": pa.array([resemblance(sketches[i], sketches[i + 1], k) for i in emit], pa.float64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return with_followers(frame, id_column, text_column).mapInArrow(run, schema)
