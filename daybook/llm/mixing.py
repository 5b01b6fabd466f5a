"""Mixing to target weights with soft memberships.

A classifier fitted on a labelled table gives every document the posterior of each domain. A document of t
tokens and rate r then counts as r * t * posterior tokens of a domain. Rates are the solution of a least
squares problem, nonnegative rates whose expected domain totals match the targets, by projected gradient
from rates of one, with momentum. Residuals are measured in the metric of the Gram matrix of the memberships, so a step
length of one is safe, and a few rounds suffice. In each round every task adds up its documents'
expected tokens, and the driver sees one number for each domain.

The classifier is a softmax regression on words of a bounded lexicon (binary) and on shares of characters;
it is fitted on at most `LABELLED_ROWS` labelled rows that have a text, those with the smallest id hashes, the
first `MAX_TRAINING_CHARS` characters of each. Everything else covers all rows and whole texts.

The rounds end when the totals meet the targets, or when they no longer move: posteriors that hardly tell
domains apart may leave no rates that meet them. `Fit` tells the residual; rounds that do neither raise.

Defined results: a null text is empty and has no tokens, its rate follows from its posterior; rows that repeat
are rated each; of rows with one id the least text is learned from; without labelled rows there is the one
domain `EVEN`, and every rate is one; targets of domains that the corpus does not have are left out, and if none is
left, ValueError; an empty table gives no rows; further columns are passed through where rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import slices
from daybook.llm.language import word_keys, words_of
from daybook.llm.sampling import among_lowest, order
from daybook.llm.scratch import fresh, shared

LABELLED_ROWS = 5000
MAX_TRAINING_CHARS = 20_000
LEXICON_WORDS = 400
TRAINING_SLICE = 256
SHARES = 8
ROUNDS = 200
TOLERANCE = 1e-4
#: Rounds in which totals must not have moved by a tenth of the tolerance to have come to rest.
REST = 5
SLICE_BYTES = 1 << 19
#: The only domain where nothing is labelled.
EVEN = "all"

_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,"]] = 3
_CLASS[10] = 4


def _shares(texts: pa.Array, words, keys: np.ndarray) -> np.ndarray:
    """Per text: shares of capitals, digits, signs and line ends, repetition of words, and size."""
    data, offsets = W.buffers(texts)
    size = np.maximum(1, np.diff(offsets))
    out = np.zeros((len(size), SHARES), np.float32)
    kinds = _CLASS[data]
    for k in range(1, 5):
        total = np.concatenate(([0], np.cumsum(kinds == k)))
        out[:, k - 1] = np.sqrt((total[offsets[1:]] - total[offsets[:-1]]) / size)
    counts = np.diff(words.firsts)
    owner = np.repeat(np.arange(len(counts)), counts)
    if len(keys):
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])))
        distinct = np.bincount(o[new], minlength=len(counts))
        out[:, 4] = 1 - distinct / np.maximum(1, counts)
        next_same = np.concatenate(((keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1]), [False]))
        out[:, 5] = np.bincount(owner, next_same, len(counts)) / np.maximum(1, counts)
    out[:, 6] = np.log1p(counts) / 10
    out[:, 7] = counts == 0
    return out


@dataclass
class Model:
    """Softmax regression over the presence of lexicon words and character shares."""

    domains: list[str]
    lexicon: np.ndarray
    weights: np.ndarray

    def _inputs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shares of each text, and the (text, lexicon word) pairs that occur."""
        words = words_of(texts.to_pylist())
        keys = word_keys(words)
        shares = _shares(texts, words, keys)
        if not len(self.lexicon) or not len(keys):
            return shares, np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, keys), len(self.lexicon) - 1)
        found = np.flatnonzero(self.lexicon[at] == keys)
        owner = np.repeat(np.arange(len(texts)), np.diff(words.firsts))[found]
        pairs = np.unique(owner * len(self.lexicon) + at[found])
        return shares, pairs // len(self.lexicon), pairs % len(self.lexicon)

    def posteriors(self, texts: pa.Array) -> np.ndarray:
        shares, text, word = self._inputs(texts)
        n = len(self.lexicon)
        score = shares @ self.weights[n:-1] + self.weights[-1]
        for k in range(len(self.domains)):
            score[:, k] += np.bincount(text, self.weights[word, k], len(shares))
        score = np.exp(score - score.max(1, keepdims=True))
        return score / score.sum(1, keepdims=True)


def fit(rows: list[tuple[str, str]], steps: int = 250, penalty: float = 1e-3) -> Model:
    """Fits the classifier on (text, domain) rows."""
    domains = sorted({d for _, d in rows})
    if not rows:
        return Model([EVEN], np.zeros(0, np.uint64), np.zeros((SHARES + 1, 1)))
    texts = pa.array([t for t, _ in rows], pa.string())
    truth = np.array([domains.index(d) for _, d in rows])
    parts = [texts.slice(i, TRAINING_SLICE) for i in range(0, len(texts), TRAINING_SLICE)]
    distinct: list[np.ndarray] = []
    for part in parts:
        words = words_of(part.to_pylist())
        keys = word_keys(words)
        distinct += [np.unique(keys[a:b]) for a, b in zip(words.firsts[:-1], words.firsts[1:])]
    text = np.repeat(np.arange(len(rows)), [len(d) for d in distinct])
    tokens, token = np.unique(np.concatenate(distinct), return_inverse=True)
    del distinct
    df = np.bincount(token, minlength=len(tokens))
    chosen: set[int] = set()
    for k in range(len(domains)):
        # words whose occurrence deviates most from what the domain's share lets expect
        share = (truth == k).mean()
        own = np.bincount(token, truth[text] == k, len(tokens))
        lift = (own - df * share) / np.sqrt(df * share * (1 - share) + 1)
        chosen.update(tokens[np.argsort(-np.abs(lift) * (df >= 5), kind="stable")[:LEXICON_WORDS]].tolist())
    model = Model(domains, np.array(sorted(chosen), np.uint64), np.zeros(0))
    x = np.zeros((len(rows), len(model.lexicon) + SHARES + 1), np.float32)
    for i, part in enumerate(parts):
        shares, own, word = model._inputs(part)
        own += i * TRAINING_SLICE
        x[own, word] = 1.0
        x[i * TRAINING_SLICE : i * TRAINING_SLICE + len(part), len(model.lexicon) : -1] = shares
    x[:, -1] = 1.0
    y = np.eye(len(domains), dtype=np.float32)[truth]
    w = np.zeros((x.shape[1], len(domains)), np.float32)
    square = np.full(w.shape, 1e-8, np.float32)
    mean = np.zeros(w.shape, np.float32)
    for step in range(1, steps + 1):  # Adam
        score = x @ w
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gradient = x.T @ (p - y) / len(rows) + penalty * w
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    model.weights = w.astype(np.float64)
    return model


def sample(frame: DataFrame, labels: DataFrame, domain: Column, id_column: str = "doc_id",
           text_column: str = "text", rows: int = LABELLED_ROWS) -> list[tuple[str, str]]:
    """(text, domain) of at most `rows` labelled rows; of an id labelled twice, the greater domain counts."""
    texts = frame.select(
        F.col(id_column).alias("id"), F.substring(text_column, 1, MAX_TRAINING_CHARS).alias("text")
    ).where("text <> ''")
    labelled = (
        labels.select(F.col(id_column).alias("id"), domain.alias("domain"))
        .where("id IS NOT NULL AND domain IS NOT NULL").groupBy("id").agg(F.max("domain").alias("domain"))
        .join(texts.select("id"), "id", "left_semi")
    )
    known = labelled.where(among_lowest("id", rows, labelled.count())).orderBy(order("id"), "id").limit(rows)
    found = texts.join(F.broadcast(known), "id").groupBy("id", "domain").agg(F.min("text").alias("text"))
    return [(r.text, r.domain) for r in sorted(found.collect(), key=lambda r: r.id)]


def memberships(frame: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
                rows: bool = False) -> DataFrame:
    """id, tokens and posteriors (in the order of the model's domains) of each row; no shuffle.

    With `rows`, in place of the id the struct `row` of all the row's columns, for `drawn`.
    """
    held = shared(frame.sparkSession, model)
    head = F.struct(*frame.columns).alias("row") if rows else F.col(id_column)
    source = frame.select(head, F.col(text_column).alias(fresh(frame, "__text")))
    name, text = source.columns
    kind = source.schema[name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                texts = part.column(text).fill_null("")
                yield pa.RecordBatch.from_arrays(
                    [part.column(name), pa.array(_tokens(texts)),
                     pa.array(list(held.value.posteriors(texts)), pa.list_(pa.float64()))],
                    [name, "tokens", "posterior"],
                )

    return source.mapInArrow(run, f"`{name}` {kind}, tokens long, posterior array<double>")


def _tokens(texts: pa.Array) -> np.ndarray:
    return np.diff(W.spans(*W.buffers(texts))[2]).astype(np.int64)


def _walk(posteriors: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps, and the point from which the next step sets out.

    Each step moves from there along the memberships, then back to what is allowed; points run
    ahead of the rates by Nesterov's momentum.
    """
    rate = ahead = np.ones(len(posteriors))
    for k, step in enumerate(steps, 1):
        before, rate = rate, np.maximum(0.0, ahead - posteriors @ step)
        ahead = rate + k / (k + 3) * (rate - before)
    return rate, ahead


def rates_of(posteriors: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    return _walk(posteriors, steps)[0]


def _columns(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    p = batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
    return batch.column("tokens").to_numpy().astype(float), p


def _summed(table: DataFrame, n: int, add) -> np.ndarray:
    """Adds up what `add` makes of each batch: a few numbers for each task, and then for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = add(*_columns(batch, n))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["place", "value"]
            )

    parts = table.select("tokens", "posterior").mapInArrow(run, "place int, value double")
    return dict(parts.groupBy("place").agg(F.sum("value")).collect())


@dataclass
class Fit:
    """The projected-gradient steps, the targets, the totals they lead to, and the largest difference of
    the two as a share of all target tokens."""

    steps: list[np.ndarray]
    targets: np.ndarray
    reached: np.ndarray

    @property
    def residual(self) -> float:
        total = self.targets.sum()
        return float(np.abs(self.reached - self.targets).max() / total) if total else 0.0


def fit_steps(table: DataFrame, domains: list[str], weights: dict[str, float], rounds: int = ROUNDS,
              tolerance: float = TOLERANCE, whole: str | None = None) -> Fit:
    """The projected-gradient steps that bring the memberships in `table` to the target weights.

    The targets' total is the largest for which no wanted domain must have more tokens than there are. With
    `whole`, it is the one for which that domain keeps all its tokens; others that have less than their
    weight then asks for are to keep all of theirs, and fall short of it.
    """
    n = len(domains)
    found = _summed(table, n, lambda t, p: (p * t[:, None]).T @ p)
    gram = np.array([found.get(i, 0.0) for i in range(n * n)]).reshape(n, n)
    have = gram.sum(1)
    if not have.sum() or domains == [EVEN]:
        return Fit([], have, have)
    want = np.array([max(0.0, weights.get(d, 0.0)) for d in domains])
    want[have <= 0] = 0.0
    if not want.sum():
        raise ValueError(f"no wanted domain among {domains}")
    want = want / want.sum()
    at = domains.index(whole) if whole in domains else None
    if at is not None and want[at] > 0:
        targets = np.minimum(want * have[at] / want[at], have)
    else:
        targets = want * min(h / w for h, w in zip(have, want) if w > 0)
    metric = np.linalg.pinv(gram + 1e-9 * have.sum() / n * np.eye(n))
    at_rates, at_point, fit, still = have, have, Fit([], targets, have), 0
    while fit.residual > tolerance and still < REST:
        if len(fit.steps) == rounds:
            raise RuntimeError(f"rates still move after {rounds} rounds, residual {fit.residual:.2g}")
        fit.steps.append(metric @ (at_point - targets))
        so_far = list(fit.steps)
        found = _summed(table, n, lambda t, p: np.array([p.T @ (t * x) for x in _walk(p, so_far)]))
        at_rates, at_point = np.array([found.get(i, 0.0) for i in range(2 * n)]).reshape(2, n)
        moved = np.abs(at_rates - fit.reached).max() / targets.sum()
        still = still + 1 if moved < tolerance / 10 else 0
        fit = Fit(fit.steps, targets, at_rates)
    return fit


def rated(table: DataFrame, steps: list[np.ndarray], domains: list[str]) -> DataFrame:
    """The table of memberships with each row's rate."""
    n = len(domains)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = rates_of(_columns(batch, n)[1], steps)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])

    return table.mapInArrow(run, f"{kinds}, rate double")


def drawn(table: DataFrame, steps: list[np.ndarray], domains: list[str], sure: float, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """The rows in a table of memberships that a draw by rates keeps, all their columns as they were; no shuffle.

    A rate of at least `sure` keeps the row; a smaller one keeps it if the row's hash, as a number from
    0 to 1, is below it, so equal rows share their fate and a second run draws the same.
    """
    n, row = len(domains), F.col("row")
    chance = F.shiftrightunsigned(F.xxhash64(row[id_column], row[text_column]), 11) / float(1 << 53)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = rates_of(_columns(batch, n)[1], steps)
            kept = pa.array((rate >= sure) | (batch.column("chance").to_numpy() < rate), pa.bool_())
            rows = batch.column("row").filter(kept)
            yield pa.RecordBatch.from_arrays(rows.flatten(), names)

    schema = table.schema["row"].dataType
    names = schema.names
    return table.select("row", "tokens", "posterior", chance.alias("chance")).mapInArrow(run, schema)
