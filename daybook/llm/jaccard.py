"""Jaccard join on word shingles by T-occurrence search (DivideSkip).

Two documents link when 100 * |A and B| >= percent * |A or B| for their sets of shingles (64-bit hashes).
Equal sets are one from the start. Candidates are found by two filters that lose no link:

1. A partner shares at least need(n) = ceil(percent * n / 100) of a set's n shingles, so it shares at least
   c of the first n - need(n) + c in any common order. Those are posted in inverted lists; c is
   EXTRA percent of n. The order is roughly from seldom to frequent, by counters over all shingles.
2. Of a set's posted shingles that any other set has posted, the c - 1 with the longest lists can be left
   out: one that is shared remains. So what many texts quote does not tie them together.

Documents that meet in a remaining list, with sizes that allow a link, form clusters: only there can
links be.

Inside a cluster the T-occurrence search is run in blocks. Of a document's inverted lists the longest are set aside
for binary probes. Of the S others a partner must be in T', so it is in one of the S - T' + 1 shortest: those are merged,
as sorted runs, and all documents that none of them names are skipped. The candidates' further occurrences in the
longer lists are probed, or, where there are more candidates than postings, counted; last come the lists set
aside. Every pair that reaches the required overlap is a link. A block gives each document's number of links,
weighed by how many rows have the same set, and a spanning forest of the links for the components.

A cluster is cut into blocks by its number of shingles, and each pair of blocks is one unit of work, so a
group of near copies that holds a third of all rows spreads over tasks. Nothing is capped.

Defined results: null and empty texts, and such without words, have empty sets and link with nothing;
a text of fewer words than a shingle has its whole sequence as one; rows with a null id have no component and no
links; rows that share an id share their fate (with different texts, too), and count as one link each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import slices
from daybook.llm.components import Union, components
from daybook.llm.membership import may_be_in
from daybook.llm.scratch import partitions, shared, written

COUNTER_BITS = 20
COUNTER_PARTS = 16
EXTRA = 15
LONG_LIST = 1 << 16
BLOCK_SHINGLES = 400_000
SKIP = 0.2
HELD_LINKS = 500_000


def need(n, percent: int):
    """Shingles of a set of n that a partner shares at least."""
    return -(-percent * n // 100)


def _sets(texts: pa.Array, size: int, fold_case: bool) -> list[np.ndarray]:
    hashes, offsets = W.shingles(texts, size, fold_case)
    return [np.unique(hashes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]


def _digest(own: np.ndarray) -> int:
    """A hash of a set, as a signed 64-bit integer."""
    if not len(own):
        return 0
    with np.errstate(over="ignore"):
        place = W.mix(np.arange(len(own), dtype=np.uint64) + np.uint64(0x51ED27)) | np.uint64(1)
        return int(W.mix(np.array([(own * place).sum() + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _read(source: DataFrame, size: int, fold_case: bool) -> DataFrame:
    """(id, n, digest) of each text; and with null n, in parts, how often each counter's shingles occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "digest", "part", "counts"]
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                sets = _sets(rows.column("text"), size, fold_case)
                total += np.bincount(_bucket(np.concatenate(sets)), minlength=len(total))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) for s in sets], pa.int64()),
                     pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())],
                    names,
                )
        if total.any():
            cut = total.reshape(COUNTER_PARTS, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(COUNTER_PARTS, pa.int64()), pa.nulls(COUNTER_PARTS, pa.int64()),
                 pa.nulls(COUNTER_PARTS, pa.int64()), pa.array(range(COUNTER_PARTS), pa.int32()),
                 pa.array([x.astype("<u4").tobytes() for x in cut], pa.binary())],
                names,
            )

    return source.mapInArrow(run, "id long, n long, digest long, part int, counts binary")


def _summed(kind: str, finish=lambda total: total):
    """Adds up the counters of each part that a task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(counts, kind).astype(np.int64)
                total[part] = total[part] + own if part in total else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.int32()),
             pa.array([finish(x).tobytes() for x in total.values()], pa.binary())],
            ["part", "counts"],
        )

    return run


def _classes(read: DataFrame) -> np.ndarray:
    """Binary logarithm of each counter over the corpus: 2**COUNTER_BITS bytes, whatever its size."""
    schema = "part int, counts binary"
    counts = read.where("n IS NULL").select("part", "counts").mapInArrow(_summed("<u4"), schema)
    whole = counts.repartition(COUNTER_PARTS, "part").mapInArrow(
        _summed("<i8", lambda total: np.log2(total + 1).astype(np.uint8)), schema
    )
    out = np.zeros((COUNTER_PARTS, (1 << COUNTER_BITS) // COUNTER_PARTS), np.uint8)
    for part, classes in whole.collect():
        out[part] = np.frombuffer(classes, np.uint8)
    return out.reshape(-1)


def _postings(source: DataFrame, classes: np.ndarray, size: int, percent: int, fold_case: bool) -> DataFrame:
    """(hash, n, digest) of the shingles by which a set must meet its partners."""
    held = shared(source.sparkSession, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets post once for each task
        for batch in batches:
            for rows in slices(batch, "text"):
                hashes, lengths, digests = [], [], []
                for own in _sets(rows.column("text"), size, fold_case):
                    digest = _digest(own)
                    if not len(own) or digest in seen:
                        continue
                    seen.add(digest)
                    first = len(own) - need(len(own), percent) + 1 + EXTRA * len(own) // 100
                    hashes.append(own[np.argsort(held.value[_bucket(own)], kind="stable")[:first]])
                    lengths.append(len(own))
                    digests.append(digest)
                if hashes:
                    times = [len(x) for x in hashes]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.repeat(lengths, times)),
                         pa.array(np.repeat(digests, times))],
                        ["hash", "n", "digest"],
                    )

    return source.where("id IS NOT NULL").mapInArrow(run, "hash long, n long, digest long")


def _lists(postings: DataFrame) -> DataFrame:
    """(hash, n, digest, df) of all postings whose list has another set in it; df is its length.

    Rows come sorted by list. A list is held until its end, or until it has LONG_LIST rows: longer ones
    count as that long, and their rows pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over = [np.zeros(0, np.int64)] * 3, None
        last = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("hash", "n", "digest")]
            if not len(rows[0]):
                continue
            new = np.ones(len(rows[0]), bool)  # equal sets of several tasks post the same
            new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])
            new[0] = last != (rows[0][0], rows[2][0])
            last = (rows[0][-1], rows[2][-1])
            rows = [np.concatenate((h, r[new])) for h, r in zip(held, rows)]
            if len(rows[0]):
                starts = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
                lengths = np.diff(np.append(starts, len(rows[0])))
                if over is not None and rows[0][0] == over:
                    lengths[0] = LONG_LIST
                    times = np.diff(np.append(starts, len(rows[0])))
                else:
                    times = lengths
                final = starts[-1]
                if lengths[-1] >= LONG_LIST:
                    over, final = rows[0][-1], len(rows[0])
                df = np.minimum(np.repeat(lengths, times), LONG_LIST)
                yield listed([r[:final] for r in rows], df[:final])
                held = [r[final:] for r in rows]
        if len(held[0]):
            df = np.full(len(held[0]), LONG_LIST if held[0][0] == over else len(held[0]), np.int64)
            yield listed(held, df)

    def listed(rows: list[np.ndarray], df: np.ndarray) -> pa.RecordBatch:
        several = df > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(x[several]) for x in (*rows, df.astype(np.int64))], ["hash", "n", "digest", "df"]
        )

    dealt = postings.repartition(partitions(postings.sparkSession), "hash")
    return dealt.sortWithinPartitions("hash", "digest").mapInArrow(run, "hash long, n long, digest long, df long")


def _meetings(postings: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of digests that hold together all documents of a list whose sizes allow a link.

    Lists are read in order of size, a row at a time; a document is tied to the one before it unless even
    that one is too small, so two documents that may link are in one cluster.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ties = None, Union()
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("hash", "n", "digest")]
            if held is not None:
                rows = [np.concatenate((h, r)) for h, r in zip(held, rows)]
            held = [r[-1:].copy() for r in rows]
            hashes, n, digests = rows
            tied = (hashes[1:] == hashes[:-1]) & (100 * n[:-1] >= percent * n[1:]) & (digests[1:] != digests[:-1])
            at = np.flatnonzero(tied)
            for a, b in zip(digests[at].tolist(), digests[at + 1].tolist()):
                ties.join(a, b)
            if len(ties.up) > HELD_LINKS:
                yield _pairs(ties.links())
                ties = Union()
        yield _pairs(ties.links())

    common = F.expr(f"1 + {EXTRA} * (({percent} * n + 99) DIV 100) DIV 100")
    frequent = Window.partitionBy("digest").orderBy(F.desc("df"), F.desc("hash"))
    kept = (
        _lists(postings).withColumn("place", F.row_number().over(frequent))
        .where(F.col("place") >= common).select("hash", "n", "digest")
    )
    dealt = kept.repartition(partitions(postings.sparkSession), "hash")
    return dealt.sortWithinPartitions("hash", "n", "digest").mapInArrow(run, "a long, b long")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"]
    )


#: A probe of a list costs as much as counting so many of its postings.
PROBE = 16


def search(queries: list[np.ndarray], indexed: list[np.ndarray], percent: int,
           same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """For each query the places of the indexed sets that link with it, by DivideSkip over inverted lists.

    `same`: both are one list, and each pair is looked for once.
    """
    sizes = np.array([len(s) for s in indexed], np.int64)
    hashes = np.concatenate([*indexed, np.zeros(0, np.uint64)])
    owners = np.repeat(np.arange(len(indexed)), sizes)
    order = np.argsort(hashes, kind="stable")  # owners ascend within a list
    hashes, owners = hashes[order], owners[order]
    tokens, starts = np.unique(hashes, return_index=True)
    ends = np.append(starts[1:], len(hashes))
    # list and owner as one ascending number, for binary probes of many lists at once
    posted = np.repeat(np.arange(len(tokens)), ends - starts) * len(indexed) + owners

    def probed(lists: np.ndarray, found: np.ndarray) -> np.ndarray:
        wanted = (lists[:, None] * len(indexed) + found[None]).ravel()
        place = np.minimum(np.searchsorted(posted, wanted), len(posted) - 1)
        return (posted[place] == wanted).reshape(len(lists), len(found)).sum(0)

    for q, own in enumerate(queries):
        n = len(own)
        at = np.searchsorted(tokens, own)
        at = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == own)] if len(tokens) else at[:0]
        least = need(n, percent)
        if not n or len(at) < least:
            continue
        lengths = (ends - starts)[at]
        at = at[np.argsort(lengths, kind="stable")]
        lengths = (ends - starts)[at]
        aside = min(least - 1, int(least / (SKIP * np.log2(lengths[-1] + 1) + 1)))
        short = len(at) - aside
        seeds = short - (least - aside) + 1
        merged = np.sort(owners[W.ranges(starts[at[:seeds]], lengths[:seeds])], kind="stable")
        found, counts = np.unique(merged, return_counts=True)
        possible = (100 * sizes[found] >= percent * n) & (100 * n >= percent * sizes[found])
        if same:
            possible &= found < q
        found, counts = found[possible], counts[possible]
        rest = at[seeds:short]
        if len(found) * len(rest) * PROBE < lengths[seeds:short].sum():
            counts = counts + probed(rest, found)
        elif len(found):
            counts = counts + np.bincount(owners[W.ranges(starts[rest], lengths[seeds:short])], minlength=len(indexed))[found]
        enough = counts >= least - aside
        found, counts = found[enough], counts[enough]
        if len(found):
            counts = counts + probed(at[short:], found)
            found = found[100 * counts >= percent * (n + sizes[found] - counts)]
        if len(found):
            yield q, found


def _cells(members: DataFrame, source: DataFrame, size: int, percent: int, fold_case: bool) -> DataFrame:
    """What each pair of blocks of each cluster finds: links (a, b) of ids that hold its components together, and for
    each id with links the row (id, id) with their number."""
    spark = members.sparkSession
    blocks = members.groupBy("cluster").agg(
        F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    texts = source.where(may_be_in(members, "node")(F.col("id"))).withColumnRenamed("id", "node")
    placed = (
        members.join(blocks, "cluster").withColumn("own", own)
        .join(texts, "node")
        .select("cluster", "own", other.alias("other"), "node", "digest", "copies", "text")
        .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "own", "node", "digest", "copies", "text")
    )
    dealt = placed.repartition(partitions(spark), "cluster", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets = None, {}
        for batch in batches:
            for rows in slices(batch, "text"):
                found = _sets(rows.column("text"), size, fold_case)
                columns = [rows.column(c).to_pylist() for c in ("cluster", "i", "j", "own", "node", "digest", "copies")]
                for cluster, i, j, own, node, digest, copies, own_set in zip(*columns, found):
                    if key != (cluster, i, j):
                        if len(sets) > 1:
                            yield _links(key, sets, percent)
                        key, sets = (cluster, i, j), {}
                    if digest == _digest(own_set):  # rows of one id may have different texts
                        sets[node] = (own, copies, own_set)
        if len(sets) > 1:
            yield _links(key, sets, percent)

    return dealt.sortWithinPartitions("cluster", "i", "j").mapInArrow(run, "a long, b long, links long")


def _links(key: tuple, sets: dict[int, tuple[int, int, np.ndarray]], percent: int) -> pa.RecordBatch:
    """A spanning forest of the links in one pair of blocks, and the number of links of each id."""
    _, i, j = key
    left = [x for x, (own, _, _) in sets.items() if own == i]
    right = [] if i == j else [x for x, (own, _, _) in sets.items() if own == j]
    nodes = np.array(left + right, np.int64)
    copies = np.array([sets[x][1] for x in nodes.tolist()], np.int64)
    links, part = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    shift = 0 if i == j else len(left)
    indexed = [sets[x][2] for x in (right or left)] if i == j or right else []
    for q, found in search([sets[x][2] for x in left], indexed, percent, i == j):
        found = found + shift
        links[q] += copies[found].sum()
        links[found] += copies[q]
        parts = np.unique(np.append(part[found], part[q]))
        if len(parts) > 1:
            part[np.isin(part, parts)] = parts[0]
    tied, linked = np.flatnonzero(part != np.arange(len(nodes))), np.flatnonzero(links)
    a = np.concatenate((nodes[tied], nodes[linked]))
    b = np.concatenate((nodes[part[tied]], nodes[linked]))
    count = np.concatenate((np.zeros(len(tied), np.int64), links[linked]))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(count)], ["a", "b", "links"])


def near_duplicates(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5,
                    percent: int = 80, fold_case: bool = False) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links, its own included) and n_links (other rows it
    links with, those of an equal set included) of each row."""
    source = frame.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    read = written(_read(source, size, fold_case), "sets")
    documents = read.where("n IS NOT NULL").select("id", "n", "digest")
    classes = _classes(read)
    meetings = _meetings(_postings(source, classes, size, percent, fold_case), percent)
    clusters = components(meetings)
    filled = documents.where("n > 0 AND id IS NOT NULL")
    first = filled.groupBy("digest").agg(
        F.min("id").alias("node"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    members = written(
        clusters.withColumnsRenamed({"node": "digest", "root": "cluster"}).join(first, "digest"), "members"
    )
    found = written(_cells(members, source.where("id IS NOT NULL"), size, percent, fold_case), "found-links")
    reached = components(found.select("a", "b"))
    linked = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    whole = (
        documents.join(first.select("digest", "node", "copies"), "digest", "left")
        .join(reached, "node", "left").join(linked, "node", "left")
        .withColumn("component_id", F.when(F.col("n") > 0, F.coalesce("root", "node", "id")).otherwise(F.col("id")))
    )
    n_links = F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    return whole.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.when(F.col("id").isNotNull() & (F.col("n") > 0), n_links).otherwise(0).cast("long").alias("n_links"),
    )
