"""Language identification by a linear-chain conditional random field over words.

Words are runs of letters. Each has features: its character bigrams and trigrams (with the word's ends),
its prefixes and suffixes of one to four letters, and itself as an entry of the lexicon learned from the
training texts. Feature weights and the weights of transitions between the labels of neighbouring words
are learned together; forward-backward gives every word's posterior, also in texts that switch language.
A text's language has the largest posterior mass, words weighed by their letters; its score is that share.

The model is fitted on a bounded sample of labelled rows (`ROWS_PER_LANGUAGE` by language, the first
`MAX_TRAINING_CHARS` characters of each); prediction covers whole texts, in numpy arrays of all words of
many texts at once. Slices of `SLICE_BYTES` and chunks of `CHUNK_LETTERS` letters bound a task's memory; a
text longer than a slice is one of its own.

Defined results: a null text or one without letters is `und` with score 0 (a combining mark is no letter, and
part of a word only after one); equal posteriors go to the smaller language; rows that repeat are predicted
each; labels on texts without letters teach nothing; without other labelled rows every text is `und`; more
languages than the bound given raise ValueError; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.batches import slices
from daybook.llm.sampling import among_lowest, order
from daybook.llm.scratch import shared
from daybook.llm.words import mix, ranges

ROWS_PER_LANGUAGE = 300
LANGUAGES = 64
MAX_TRAINING_CHARS = 20_000
TABLE_BITS = 17
AFFIXES = 4
LEXICON_WORDS = 2000
UNKNOWN = "und"
SLICE_BYTES = 1 << 19
CHUNK_LETTERS = 1 << 17

_TABLES: dict[str, np.ndarray] = {}


def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: its lower-case letter, whether it is a letter, and whether a combining mark."""
    if not _TABLES:
        lower = np.arange(0x110000, dtype=np.uint32)
        letter, mark = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
        for c in (*range(0xD800), *range(0xE000, 0x110000)):
            x = chr(c)
            if x.isalpha():
                letter[c] = True
                small = x.lower()
                if len(small) == 1:
                    lower[c] = ord(small)
            elif unicodedata.combining(x):
                mark[c] = True
        _TABLES["lower"], _TABLES["letter"], _TABLES["mark"] = lower, letter, mark
    return _TABLES["lower"], _TABLES["letter"], _TABLES["mark"]


@dataclass
class Words:
    """The words of some texts: lower-case letters one after another, and where words and texts start."""

    letters: np.ndarray
    starts: np.ndarray  # of words in letters
    lengths: np.ndarray
    firsts: np.ndarray  # n + 1: of texts in words
    places: np.ndarray  # first code point of each word in its text


def words_of(texts: list[str | None]) -> Words:
    lower, letter, mark = _letters()
    sizes = np.array([len(x) if x else 0 for x in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    joined = "\n".join(x or "" for x in texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = letter[points] | mark[points]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    marked = np.flatnonzero(mark[points[begin]])
    if len(marked):  # a word begins with its first letter
        known = np.append(np.flatnonzero(letter[points]), len(points))
        begin[marked] = known[np.searchsorted(known, begin[marked])]
        begin, end = begin[begin < end], end[begin < end]
    lengths = end - begin
    starts = np.cumsum(lengths) - lengths
    firsts = np.concatenate(([0], np.searchsorted(begin, ends)))
    owner = np.repeat(np.arange(len(texts)), np.diff(firsts))
    places = begin - (ends - sizes - 1)[owner] if len(texts) else begin
    return Words(lower[points[ranges(begin, lengths)]], starts, lengths, firsts, places)


def _salted(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        y ^= y >> np.uint64(29)
        y *= np.uint64(0xBF58476D1CE4E5B9)
    return (y >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


def word_keys(words: Words) -> np.ndarray:
    """A hash of each whole word."""
    n = len(words.letters)
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        at = np.arange(n, dtype=np.int64) - np.repeat(words.starts, words.lengths)
        step = mix(np.arange(int(words.lengths.max()), dtype=np.uint64) + np.uint64(77)) | np.uint64(1)
        return mix(np.add.reduceat((words.letters.astype(np.uint64) + np.uint64(1)) * step[at], words.starts))


def features(words: Words, lexicon: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of the weight table: by letter (bigrams, trigrams) and by word (affixes, lexicon).

    The last row of the table stands for "no such feature" and stays zero.
    """
    none = np.int32((1 << TABLE_BITS) + len(lexicon))
    c = words.letters.astype(np.uint64)
    n, last = len(c), words.starts + words.lengths - 1
    after = np.zeros(n, np.uint64)
    after[:-1] = c[1:]
    before = np.zeros(n, np.uint64)
    before[1:] = c[:-1]
    after[last], before[words.starts] = 0, 0
    by_letter = [
        _salted((c << np.uint64(21)) | after, 1),
        _salted((before << np.uint64(42)) | (c << np.uint64(21)) | after, 2),
    ]
    by_word = []
    for sign, edge in ((1, words.starts), (-1, last)):
        value = np.zeros(len(edge), np.uint64)
        for k in range(AFFIXES):
            at = np.clip(edge + sign * k, 0, max(0, n - 1))
            with np.errstate(over="ignore"):
                value = value * np.uint64(0x100000001B3) + c[at]
            rows = _salted(value, 10 + k + (sign > 0) * AFFIXES)
            by_word.append(np.where(words.lengths > k, rows, none))
    if len(lexicon):
        keys = word_keys(words)
        found = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
        by_word.append(np.where(lexicon[found] == keys, (1 << TABLE_BITS) + found, none).astype(np.int32))
    return by_letter, by_word


@dataclass
class Chain:
    """Texts in order of falling word count, all first words, then all second ones, and so on."""

    firsts: np.ndarray
    active: np.ndarray = field(init=False)
    offsets: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)  # place in the chain -> word

    def __post_init__(self):
        counts = np.diff(self.firsts)
        texts = np.argsort(-counts, kind="stable")
        ranked = counts[texts]
        longest = int(ranked[0]) if len(ranked) else 0
        self.active = np.searchsorted(-ranked, -np.arange(longest), side="left")
        self.offsets = np.concatenate(([0], np.cumsum(self.active)))
        rank = np.empty(len(texts), np.int64)
        rank[texts] = np.arange(len(texts))
        owner = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(int(self.firsts[-1]), dtype=np.int64) - self.firsts[:-1][owner]
        place = self.offsets[step] + rank[owner] if len(step) else step
        self.order = np.empty(len(step), np.int64)
        self.order[place] = np.arange(len(step))


def forward_backward(emission: np.ndarray, transition: np.ndarray, chain: Chain,
                     count_pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word's label and, if asked for, expected counts of label pairs."""
    e = emission[chain.order]
    e = np.exp(e - e.max(1, keepdims=True))
    move = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(e), np.empty_like(e)
    pairs = np.zeros_like(move)
    cuts, active = chain.offsets.tolist(), chain.active.tolist()
    for t, n in enumerate(active):
        here = e[cuts[t] : cuts[t] + n]
        if t:
            here = here * (alpha[cuts[t - 1] : cuts[t - 1] + n] @ move)
        alpha[cuts[t] : cuts[t] + n] = here / here.sum(1, keepdims=True)
    for t in range(len(active) - 1, -1, -1):
        a, n = cuts[t], active[t]
        beta[a : a + n] = 1.0
        if t + 1 < len(active):
            b, m = cuts[t + 1], active[t + 1]
            ahead = e[b : b + m] * beta[b : b + m]
            back = ahead @ move.T
            beta[a : a + m] = back / back.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(1, keepdims=True)
    if count_pairs and len(active) > 1:
        first = [np.arange(cuts[t - 1], cuts[t - 1] + n) for t, n in enumerate(active) if t]
        i = np.concatenate(first)
        j = np.arange(cuts[1], cuts[-1])
        joint = alpha[i][:, :, None] * move[None] * (e[j] * beta[j])[:, None, :]
        pairs = (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    posterior = np.empty_like(gamma)
    posterior[chain.order] = gamma
    return posterior, pairs


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    transition: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Sums of the weights of each word's features, in chunks of words."""
        out = np.zeros((len(words.starts), len(self.languages)), np.float32)
        i = 0
        while i < len(out):
            low = words.starts[i]
            j = max(i + 1, int(np.searchsorted(words.starts, low + CHUNK_LETTERS)))
            high = words.starts[j - 1] + words.lengths[j - 1]
            part = Words(words.letters[low:high], words.starts[i:j] - low, words.lengths[i:j], words.firsts[:0], words.places[:0])
            by_letter, by_word = features(part, self.lexicon)
            sums = sum(self.weights[rows] for rows in by_letter)
            np.add.reduceat(sums, part.starts, axis=0, out=out[i:j])
            for rows in by_word:
                out[i:j] += self.weights[rows]
            i = j
        return out

    def label(self, words: Words) -> np.ndarray:
        """Posterior of the languages for each word."""
        if not len(words.starts):
            return np.zeros((0, len(self.languages)))
        emission = self.emissions(words).astype(np.float64)
        return forward_backward(emission, self.transition, Chain(words.firsts))[0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words = words_of(texts)
        mass = np.zeros((len(texts), len(self.languages) or 1))
        if len(words.starts) and self.languages:
            weighed = self.label(words) * words.lengths[:, None]
            total = np.vstack((np.zeros(weighed.shape[1]), np.cumsum(weighed, axis=0)))
            mass = total[words.firsts[1:]] - total[words.firsts[:-1]]
        size = mass.sum(1)
        best = mass.argmax(1)
        share = np.where(size > 0, mass[np.arange(len(best)), best] / np.where(size > 0, size, 1), 0.0)
        names = [self.languages[b] if s > 0 else UNKNOWN for b, s in zip(best, size)]
        return names, np.clip(share, 0.0, 1.0)

    def runs(self, text: str | None) -> list[tuple[int, int, str]]:
        """The text's runs of words in one language: (start, end) in code points and the language."""
        words = words_of([text])
        out: list[tuple[int, int, str]] = []
        if not self.languages:
            return out
        for place, length, best in zip(words.places, words.lengths, self.label(words).argmax(1)):
            name = self.languages[best]
            if out and out[-1][2] == name:
                out[-1] = (out[-1][0], int(place + length), name)
            else:
                out.append((int(place), int(place + length), name))
        return out


def fit(rows: list[tuple[str, str]], steps: int = 240, sequences: int = 192, seed: int = 7) -> Model:
    """Fits the field on (text, language) rows by stochastic gradients of its likelihood (Adagrad).

    Texts are labelled as a whole, so training sequences that switch language are made of runs of
    words from texts of different languages.
    """
    languages = sorted({lang for _, lang in rows})
    n = len(languages)
    words = words_of([text for text, _ in rows])
    label = np.array([languages.index(lang) for _, lang in rows], np.int64)
    owner = np.repeat(np.arange(len(rows)), np.diff(words.firsts))
    keys = word_keys(words)
    lexicon: set[int] = set()
    for k in range(n):
        seen, count = np.unique(keys[label[owner] == k], return_counts=True)
        lexicon.update(seen[np.argsort(-count, kind="stable")[:LEXICON_WORDS]].tolist())
    model = Model(languages, np.array(sorted(lexicon), np.uint64), np.zeros(0), np.zeros((n, n)))
    model.weights = np.zeros(((1 << TABLE_BITS) + len(lexicon) + 1, n), np.float32)
    filled = [np.flatnonzero((label == k) & (np.diff(words.firsts) > 0)) for k in range(n)]
    filled = [x for x in filled if len(x)]
    if not filled:
        return model
    rng = np.random.default_rng(seed)
    squares = np.full(model.weights.shape, 1e-2, np.float32)
    pair_squares = np.full((n, n), 1e-2)
    for step in range(steps):
        taken, firsts = [], [0]
        for _ in range(sequences):
            for _ in range(rng.integers(1, 4)):
                text = rng.choice(filled[rng.integers(len(filled))])
                a, b = words.firsts[text], words.firsts[text + 1]
                size = min(b - a, rng.integers(2, 40))
                first = rng.integers(a, b - size + 1)
                taken.append(np.arange(first, first + size))
            firsts.append(sum(map(len, taken)))
        picked = np.concatenate(taken)
        lengths = words.lengths[picked]
        starts = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) + np.repeat(words.starts[picked] - starts, lengths)
        some = Words(words.letters[at], starts, lengths, np.array(firsts), words.places[picked])
        truth = label[owner[picked]]
        by_letter, by_word = features(some, model.lexicon)
        emission = np.add.reduceat(sum(model.weights[r] for r in by_letter), starts, axis=0)
        for rows_ in by_word:
            emission += model.weights[rows_]
        posterior, pairs = forward_backward(
            emission.astype(np.float64), model.transition, Chain(some.firsts), count_pairs=True
        )
        error = -posterior
        error[np.arange(len(truth)), truth] += 1.0
        inner = np.ones(len(truth), bool)
        inner[some.firsts[:-1]] = False
        j = np.flatnonzero(inner)
        seen = np.zeros((n, n))
        np.add.at(seen, (truth[j - 1], truth[j]), 1.0)
        by_letter_error = np.repeat(error, lengths, axis=0)
        rows_all = np.concatenate([*by_letter, *by_word])
        errors = np.concatenate([by_letter_error] * len(by_letter) + [error] * len(by_word))
        used, inverse = np.unique(rows_all, return_inverse=True)
        gradient = np.column_stack([np.bincount(inverse, errors[:, k], len(used)) for k in range(n)])
        gradient = gradient / sequences - 1e-4 * model.weights[used]
        squares[used] += gradient**2
        model.weights[used] += 0.2 * gradient / np.sqrt(squares[used])
        model.weights[-1] = 0.0
        change = (seen - pairs) / sequences
        pair_squares += change**2
        model.transition += 0.2 * change / np.sqrt(pair_squares)
    return model


def sample(frame: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text",
           label_column: str = "lang", rows: int = ROWS_PER_LANGUAGE, languages: int = LANGUAGES) -> list[tuple[str, str]]:
    """At most `rows` labelled texts of each language, those with the smallest hashes of id and text.

    Longer texts are cut to MAX_TRAINING_CHARS. The driver gets `rows` of each of at most `languages` languages.
    """
    label, text = F.col(label_column).cast("string"), F.substring(text_column, 1, MAX_TRAINING_CHARS)
    labelled = frame.where(learn & label.isNotNull()).select(
        label.alias("lang"), F.struct(F.col(id_column).alias("id"), text.alias("text")).alias("id"), text.alias("text")
    ).where(F.col("text").rlike(r"\p{L}"))
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("id").alias("count")).limit(languages + 1).collect()
    if len(counts) > languages:
        raise ValueError(f"more than {languages} labelled languages: raise the bound `languages`")
    if not counts:
        return []
    low = reduce(
        lambda a, b: a | b,
        [(F.col("lang") == r["lang"]) & among_lowest("id", rows, r["count"]) for r in counts],
    )
    lowest = Window.partitionBy("lang").orderBy("order", "text")
    found = labelled.where(low).select("lang", order("id").alias("order"), "text").distinct()
    kept = found.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= rows).collect()
    return [(r.text, r.lang) for r in sorted(kept, key=lambda r: (r.lang, r.place))]


def identify(frame: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
             also: tuple[str, ...] = ()) -> DataFrame:
    """The given columns of each row with lang_pred and score; one pass, no shuffle."""
    held = shared(frame.sparkSession, model)
    kept = list(dict.fromkeys((id_column, *also)))
    source = frame.select(*kept, F.col(text_column).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "__text", SLICE_BYTES):
                names, scores = held.value.predict(rows.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*kept, "lang_pred", "score"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text")
    return source.mapInArrow(run, f"{schema}, lang_pred string, score double")


def accepted(frame: DataFrame, model: Model, least: float, text_column: str = "text") -> DataFrame:
    """The rows whose text has a language with a score of at least `least`, all columns as they are."""
    held = shared(frame.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, text_column, SLICE_BYTES):
                names, scores = held.value.predict(rows.column(text_column).to_pylist())
                kept = [name != UNKNOWN and score >= least for name, score in zip(names, scores)]
                yield rows.filter(pa.array(kept, pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def label_runs(frame: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id and the runs of words in one language: start and end in code points, and the language."""
    held = shared(frame.sparkSession, model)
    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                found = [
                    [{"start": a, "end": b, "lang": x} for a, b, x in held.value.runs(t)]
                    for t in rows.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(found, spans)], ["id", "runs"])

    made = source.mapInArrow(run, f"id {kind}, runs array<struct<start: long, end: long, lang: string>>")
    return made.withColumnRenamed("id", id_column)
