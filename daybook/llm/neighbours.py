"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. It is posted in the inverted files of the first
`POSTS` of them, files sorted by the pivot's place in the order. A query visits the files of its first `PROBES`; of
the rows that it meets there, the nearest `SHARE` by footrule distance (over the query's prefix; a pivot beyond the
row's counts as just after it), and `LEAST` of them at least, ties included, are reranked by Euclidean distance on the
vectors in double precision. All other rows are neither ranked nor compared. The shares grow with the files, so recall
does not fall with size.

The index lies with the rows: each block of rows has its own files, so a row is written once, with its order, and never
copied for a file or a query. Queries come to the rows, in broadcasts of `QUERIES` at most; a task reads its rows once
for each of these and sends k rows for each query. Pivots are at most `PIVOTS` rows with the smallest id hashes, a
bounded sample, and at most a third of the rows; every row is indexed.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor those of another length than most; of rows with one id the least vector counts; equal distances go
to the smaller id; with fewer candidates than asked for, all that were found are returned; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.sampling import among_lowest, order
from daybook.llm.scratch import folder, shared, written

PIVOTS = 2048
PREFIX = 128
POSTS = 24
PROBES = 32
SHARE = 0.5
LEAST = 64
QUERIES = 4096
BLOCK_ROWS = 8192
#: Rows found that a task holds before it keeps the best k of each query.
HELD = 500_000


def usable(vector: str) -> Column:
    """Whether the vector has only finite components, one of them not zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The first `length` pivots by distance, ties to the lower number."""
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * vectors @ pivots.T
    return np.argsort(squares, 1, kind="stable")[:, :length].astype(np.int16)


def represent(frame: DataFrame, pivots: np.ndarray, length: int, kind: str) -> DataFrame:
    """id, query, vector (bytes of its components, `kind` each) and order (bytes of pivot numbers) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                rows = batch.slice(start, 2048)
                flat = rows.column("vector").flatten().to_numpy(zero_copy_only=False).astype(kind)
                vectors = flat.reshape(rows.num_rows, pivots.shape[1])
                near = orders(vectors.astype(np.float64), pivots, length)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("query"), pa.array([v.tobytes() for v in vectors], pa.binary()),
                     pa.array([o.tobytes() for o in near], pa.binary())],
                    ["id", "query", "vector", "order"],
                )

    return frame.mapInArrow(run, "id long, query boolean, vector binary, order binary")


@dataclass
class Rows:
    """Ids, vectors and orders of some rows."""

    ids: np.ndarray
    vectors: np.ndarray
    orders: np.ndarray

    @classmethod
    def of(cls, table: pa.RecordBatch | pa.Table, kind: str, length: int) -> Rows:
        def matrix(name: str, kind, width: int = -1) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, width)

        return cls(table.column("id").to_numpy(), matrix("vector", kind).astype(np.float64), matrix("order", np.int16, length))


class Files:
    """The inverted files of a block of rows: posted rows sorted by pivot, and by its place in their order."""

    def __init__(self, rows: Rows, posts: int):
        self.rows, self.posts = rows, posts
        keys = rows.orders[:, :posts].astype(np.int64) * posts + np.arange(posts)
        sorted_ = np.argsort(keys.ravel(), kind="stable")
        self.keys, self.owners = keys.ravel()[sorted_], sorted_ // posts

    def met(self, order: np.ndarray) -> np.ndarray:
        """The rows in the files of the given pivots."""
        first = np.searchsorted(self.keys, order.astype(np.int64) * self.posts)
        end = np.searchsorted(self.keys, (order.astype(np.int64) + 1) * self.posts)
        seen = np.zeros(len(self.rows.ids), bool)
        for a, b in zip(first.tolist(), end.tolist()):
            seen[self.owners[a:b]] = True
        return np.flatnonzero(seen)

    def nearest(self, identity: int, vector: np.ndarray, order: np.ndarray, places: np.ndarray, k: int, probes: int,
                share: float) -> tuple[np.ndarray, np.ndarray, int, int]:
        """Ids and distances of the k nearest found, how many rows were ranked, and how many compared."""
        found = self.met(order[:probes])
        found = found[self.rows.ids[found] != identity]
        if not len(found):
            return np.zeros(0, np.int64), np.zeros(0), 0, 0
        own = self.rows.orders[found]
        far = np.abs(places[own] - np.arange(own.shape[1], dtype=np.int16)).sum(1, dtype=np.int32)
        kept = max(LEAST, int(np.ceil(share * len(found))))
        near = found if kept >= len(found) else found[far <= np.partition(far, kept - 1)[kept - 1]]
        score = np.sqrt(((self.rows.vectors[near] - vector) ** 2).sum(1))
        ids = self.rows.ids[near]
        best = np.lexsort((ids, score))[:k]
        return ids[best], score[best], len(found), len(near)


def places_of(orders: np.ndarray, pivots: int) -> np.ndarray:
    """Place of each pivot in each order; pivots beyond the prefix share the place after it."""
    length = orders.shape[1]
    out = np.full((len(orders), pivots), length, np.int16)
    np.put_along_axis(out, orders.astype(np.int64), np.arange(length, dtype=np.int16)[None], 1)
    return out


def _best(parts: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query among (query, id, score) arrays."""
    query, ids, score = (np.concatenate(x) for x in zip(*parts))
    sorted_ = np.lexsort((ids, score, query))
    query, ids, score = query[sorted_], ids[sorted_], score[sorted_]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], ids[rank < k], score[rank < k]


def search(frame: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id",
           vector_column: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX,
           posts: int = POSTS, probes: int = PROBES, share: float = SHARE) -> DataFrame:
    """query_id, rank, id and score of the k nearest rows found for each row that `queries` picks."""
    spark = frame.sparkSession
    schema = f"query_id long, rank int, {id_column} long, score double"
    kind = "<f4" if frame.schema[vector_column].dataType.simpleString() == "array<float>" else "<f8"
    rows = (
        frame.where(usable(vector_column) & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("query"),
                F.col(vector_column).cast("array<float>" if kind == "<f4" else "array<double>").alias("vector"))
        .groupBy("id").agg(F.max("query").alias("query"), F.min("vector").alias("vector"))
    )
    sizes = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").head(1)
    if not sizes:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == sizes[0][0])
    wanted = max(1, min(pivots, sizes[0][1] // 3))
    few = rows.where(among_lowest("id", wanted, sizes[0][1]))
    sample = few.orderBy(order("id"), "id").limit(wanted).select("vector").collect()
    points = np.unique(np.array([r[0] for r in sample], float), axis=0)
    count, length = len(points), min(prefix, len(points))
    known = written(represent(rows, points, length, kind), "permutations")
    asked = known.where("query")
    chunks = max(1, -(-2 * asked.count() // QUERIES))  # twice as many as needed, as hashes don't fill them evenly
    found, part = folder(spark, "neighbours"), F.pmod(F.xxhash64("id"), F.lit(chunks))
    for chunk in range(chunks):
        some = asked.where(part == chunk).select("id", "vector", "order").toArrow()
        if some.num_rows:
            held = shared(spark, Rows.of(some, kind, length))
            _visited(known, held, kind, length, count, k, min(posts, length), probes, share).write.mode("append").parquet(found)
            held.destroy()
    if not asked.head(1):
        return spark.createDataFrame([], schema)
    nearest = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        spark.read.schema("query_id long, id long, score double").parquet(found)
        .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
    )


def _visited(known: DataFrame, held, kind: str, length: int, pivots: int, k: int, posts: int, probes: int,
             share: float) -> DataFrame:
    """query_id, id and score of the k nearest rows that each task finds for each of the broadcast queries."""
    names = ["query_id", "id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Rows = held.value
        parts: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                files = Files(Rows.of(batch.slice(start, BLOCK_ROWS), kind, length), posts)
                for i, identity in enumerate(queries.ids.tolist()):
                    order_ = queries.orders[i]
                    places = places_of(order_[None], pivots)[0]
                    ids, score, _, _ = files.nearest(identity, queries.vectors[i], order_, places, k, probes, share)
                    parts.append((np.full(len(ids), identity), ids, score))
                if sum(len(x[1]) for x in parts) > HELD:
                    parts = [_best(parts, k)]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _best(parts, k)], names)

    return known.select("id", "vector", "order").mapInArrow(run, "query_id long, id long, score double")
