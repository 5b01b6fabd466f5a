"""Exact k-means on integer vectors, with ns-bounds.

Vectors are quantised to integers, so squared distances, sums and centroids are exact, and so is every
assignment. A vector keeps its distance to each centroid together with the round in which it was worked out, and all
centroids of all rounds are kept (k vectors a round). In a later round a stored distance is loosened by the norm of that
centroid's displacement since: the distance to its own centroid can have grown by it, one to another can have
shrunk by it. The norm is that of the displacement as a whole, not the sum of the rounds' drifts, so a centroid that
comes back loosens nothing. While the upper bound of its own centroid is below the lower bounds of all others, a
vector keeps its centroid unseen. Else its own distance is worked out anew, and then that to every centroid whose
lower bound still fails; ties and the choice go by exact integers.

A round is one pass: tasks carry state along with their vectors in a cached frame, send what
the vectors that moved add to and take from each cluster, and the driver sees k sums of whole vectors. A lost executor's
part of the cache is computed again from the table; a round needs the round before and the centroids alone.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part; a component
beyond `LARGEST` (2**17) in size raises, as its squares would not be exact; rows that repeat are vectors like any
other; rows with a null id are clustered, too, but start no centroid; of equal hashes the least vector starts one;
equal distances go to the smaller centroid; with fewer vectors than k there are as many centroids as distinct ids allow, with
none no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.scratch import written

SCALE = 1024
LARGEST = 1 << 17
#: Bounds are floating point: they decide only when they differ by more than this share.
MARGIN = 1e-9
STEP_ROWS = 4096
_STATE = "cluster int, before int, evaluations int, distances array<double>, rounds array<tinyint>"


def usable(vector: str, width: int):
    """Whether the vector has `width` components, all of them finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(x) == width) & finite, F.lit(False))


def quantised(frame: DataFrame, id_column: str, vector_column: str, width: int) -> DataFrame:
    """id and vector (floor of SCALE times each component) of the usable rows."""
    source = frame.where(usable(vector_column, width)).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            if len(flat) and np.abs(flat).max() > LARGEST:
                raise ValueError(f"a component is greater than {LARGEST} in size")
            whole = pa.array(np.floor(flat * SCALE).astype(np.int32))
            ends = pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, whole)], ["id", "vector"])

    return source.mapInArrow(run, "id long, vector array<int>")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes of seed and id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.where("id IS NOT NULL").select(name.alias("name"), "vector").orderBy("name", "vector").limit(k)
    return np.array([r.vector for r in first.collect()], np.int64)


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, one row for each vector."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    if 4 * most * most * vectors.shape[1] < 1 << 53:  # sums of doubles are exact, too
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v**2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * (v @ c.T)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], 1)


def start(vectors: np.ndarray, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """The state after the first round: all distances are worked out."""
    d = squares(vectors, centroids)
    n = len(d)
    return {
        "cluster": d.argmin(1), "before": np.full(n, -1), "evaluations": np.full(n, d.shape[1]),
        "distances": np.sqrt(d.astype(np.float64)), "rounds": np.zeros(d.shape, np.int8),
    }


def assign(vectors: np.ndarray, state: dict[str, np.ndarray], history: np.ndarray) -> dict[str, np.ndarray]:
    """The state of vectors after the round of the last centroids in `history`."""
    now, k = len(history) - 1, history.shape[1]
    moved = np.sqrt(((history - history[-1]).astype(np.float64) ** 2).sum(2))  # of each round and centroid
    rows, each = np.arange(len(vectors)), np.arange(k)
    cluster = state["cluster"]
    loose = moved[state["rounds"], each]
    lower = (state["distances"] - loose) * (1 - MARGIN)
    upper = state["distances"][rows, cluster] + loose[rows, cluster]
    lower[rows, cluster] = np.inf
    out = {**state, "before": cluster}
    open_ = np.flatnonzero(upper * (1 + MARGIN) >= lower.min(1))
    if not len(open_):
        return out
    out = {name: x.copy() for name, x in out.items()}
    rows, mine = rows[: len(open_)], cluster[open_]
    exact = np.full((len(open_), k), np.iinfo(np.int64).max)
    exact[rows, mine] = ((vectors[open_] - history[-1][mine]) ** 2).sum(1)
    failed = np.sqrt(exact[rows, mine].astype(np.float64))[:, None] * (1 + MARGIN) >= lower[open_]
    i, j = np.nonzero(failed)
    exact[i, j] = ((vectors[open_[i]] - history[-1][j]) ** 2).sum(1)
    failed[rows, mine] = True
    i, j = np.nonzero(failed)
    out["distances"][open_[i], j] = np.sqrt(exact[i, j].astype(np.float64))
    out["rounds"][open_[i], j] = now
    out["evaluations"][open_] += failed.sum(1)
    out["cluster"][open_] = exact.argmin(1)
    return out


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _listed(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))


def _round(source: DataFrame, history: np.ndarray) -> DataFrame:
    """One pass: every vector with its state after the round."""
    k, width = history.shape[1:]
    names = ["cluster", "before", "evaluations"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(first, STEP_ROWS)
                vectors = _vectors(batch, width)
                if len(history) == 1:
                    state = start(vectors, history[0])
                else:
                    known = {c: batch.column(c).to_numpy() for c in names}
                    for c in ("distances", "rounds"):
                        known[c] = batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                    state = assign(vectors, known, history)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("vector"), *(pa.array(state[c], pa.int32()) for c in names),
                     _listed(state["distances"]), _listed(state["rounds"])],
                    ["id", "vector", *names, "distances", "rounds"],
                )

    return source.mapInArrow(run, f"id long, vector array<int>, {_STATE}")


def _moved(state: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that moved add to the sum and the count of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            vectors = np.column_stack((_vectors(batch, width), np.ones(batch.num_rows, np.int64)))
            before, now = batch.column("before").to_numpy(), batch.column("cluster").to_numpy()
            for j in range(k):
                total[j] += vectors[now == j].sum(0) - vectors[before == j].sum(0)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total.ravel()[place])], ["place", "value"])

    parts = state.where("cluster <> before").select("vector", "before", "cluster").mapInArrow(run, "place int, value long")
    out = np.zeros(k * (width + 1), object)
    for place, value in parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38, 0)"))).collect():
        out[place] = int(value)
    out = out.reshape(k, width + 1)
    return out[:, :-1], out[:, -1]


def cluster(frame: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, width: int = 64, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 and evaluations (of a distance) of each vector."""
    spark = frame.sparkSession
    vectors = quantised(frame, id_column, vector_column, width)
    centroids = first_centroids(vectors, k, seed)
    schema = f"{id_column} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, evaluations int"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    history = centroids[None]
    k = len(centroids)
    sums, counts = np.zeros((k, width), object), np.zeros(k, object)
    held, state = [], vectors
    try:
        for _ in range(rounds):
            state = _round(state, history).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(state)
            added, more = _moved(state, k, width)
            sums, counts = sums + added, counts + more
            if len(held) > 1:
                held.pop(0).unpersist()
            full = counts > 0
            centroids = centroids.copy()
            centroids[full] = (sums[full] // counts[full][:, None]).astype(np.int64)
            history = np.concatenate((history, centroids[None]))
        found = written(_distances(_round(state, history), centroids), "clusters")
    finally:
        for cached in held:
            cached.unpersist()
    totals = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(j, totals.get(j, 0), sum(totals.values()), names[j]) for j in range(k)]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "evaluations"
    )


def _distances(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, cluster, exact squared distance and evaluations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            far = ((_vectors(batch, centroids.shape[1]) - centroids[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("cluster"), pa.array(far, pa.int64()), batch.column("evaluations")],
                ["id", "cluster", "distance", "evaluations"],
            )

    kept = state.select("id", "vector", "cluster", "evaluations")
    return kept.mapInArrow(run, "id long, cluster int, distance long, evaluations int")
