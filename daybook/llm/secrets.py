"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base spans come from three patterns: assignments to names that tell of secrets, access keys and long
hexadecimal runs. Beyond them, runs of [A-Za-z0-9+/_=-] are cut after every '=' that isn't closing padding, and
parts that no alphabet has are cut twice, at '-' and '_' and at '+' and '/'; every part of 20 or more characters
is a candidate, so candidates of one run may overlap. Its
encoding is the smallest of `ENCODINGS` that has all its characters. Three tests ask whether it could
be drawn at random from that alphabet: chi-squared of the character counts, the runs test (above and
below the alphabet's middle) and the serial correlation of neighbours. A candidate that fails one at `ALPHA`
is ordinary text. For the others, the chance that ordinary text of the same length looks as uniform is
worked out from the characters of the whole corpus; the Benjamini-Hochberg rule then picks, for each
encoding and band of lengths apart, those that keep the expected share of false discoveries below `RATE`.

The corpus is read once; what the driver sees are character counts and, for each encoding and band, a
histogram of chances. Runs of digits alone are no candidates: they can't be told from numbers.

Defined results: a null text is empty and has no span; rows that repeat are scanned each; an empty table
gives no rows; further columns are not read; whole texts are scanned, however long.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import slices
from daybook.llm.scratch import written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "upper_hex": DIGITS + "ABCDEF",
    "base32": LOWER.upper() + "234567",
    "base36": DIGITS + LOWER,
    "base62": DIGITS + LOWER.upper() + LOWER,
    "base64": LOWER.upper() + LOWER + DIGITS + "+/",
    "base64url": LOWER.upper() + LOWER + DIGITS + "-_",
}
LEAST = 20
ALPHA = 0.001
RATE = 0.01
BANDS = (28, 40, 64)
BINS_A_DECADE, DECADES = 20, 60

_RUN = np.zeros(256, bool)
_RUN[[ord(c) for c in ENCODINGS["base62"] + "+/_=-"]] = True
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in ENCODINGS["hex"]]] = True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, by start, then by kind as listed."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def encoding(token: str) -> str | None:
    """The smallest alphabet that has all characters of the token without its padding."""
    used = set(token.rstrip("="))
    if not used or used <= set(DIGITS):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if used <= set(alphabet)), None)


def parts(run: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates in a run: what lies between '=' signs, the closing ones with the last;
    where that mixes the signs of base64 and base64url, the longest parts that each of them has."""
    out = set()
    for m in re.finditer(r"[^=]+(?:=+\Z)?", run):
        mixed = re.search("[+/]", m[0]) and re.search("[-_]", m[0])
        for cut in ("[^-_]+", "[^+/]+") if mixed else (".+",):
            out.update((m.start() + x.start(), m.start() + x.end()) for x in re.finditer(cut, m[0]))
    return sorted((a, b) for a, b in out if len(run[a:b].rstrip("=")) >= LEAST)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str, name: str) -> tuple[float, float, float, float]:
    """The chi-squared statistic and the p-values of the three tests under uniform random draws."""
    alphabet = ENCODINGS[name]
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in token.rstrip("=")])
    n, size = len(x), len(alphabet)
    counts = np.bincount(x, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    spread = math.sqrt(2 * (size - 1) * (1 - 1 / n))
    p_chi = 0.5 * math.erfc((chi - (size - 1)) / spread / math.sqrt(2))
    high = x >= size / 2
    above = int(high.sum())
    below = n - above
    if above and below:
        changes = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * above * below / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _two_sided((changes - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    y = x - x.mean()
    square = float((y * y).sum())
    p_serial = _two_sided((float((y[1:] * y[:-1]).sum()) / square + 1 / n) * math.sqrt(n)) if square else 0.0
    return chi, p_chi, p_runs, p_serial


def ordinary_chance(chi: float, n: int, shares: np.ndarray) -> float:
    """Chance that n characters of ordinary text have a chi-squared as small, by its normal limit."""
    size = len(shares)
    lean = shares - 1 / size
    mean = size * float((shares * (1 - shares)).sum()) + n * size * float((lean**2).sum())
    variance = 4 * n * size**2 * (float((shares * lean**2).sum()) - float((shares * lean).sum()) ** 2)
    variance += 2 * size * float((shares * (1 - shares)).sum())
    return 0.5 * math.erfc((mean - chi) / math.sqrt(2 * variance))


def _band(n: int) -> int:
    return sum(n >= b for b in BANDS)


def _bin(p: float) -> int:
    return min(BINS_A_DECADE * DECADES, int(-math.log10(max(p, 1e-300)) * BINS_A_DECADE))


def thresholds(histogram: dict[tuple[str, int, int], int], rate: float = RATE) -> dict[tuple[str, int], int]:
    """For each encoding and band, the lowest bin of chances that Benjamini-Hochberg accepts.

    A bin stands for its largest chance, so the rule errs on the strict side.
    """
    out: dict[tuple[str, int], int] = {}
    for group in {(e, b) for e, b, _ in histogram}:
        bins = {k: n for (e, b, k), n in histogram.items() if (e, b) == group}
        total, seen = sum(bins.values()), 0
        for k in sorted(bins, reverse=True):
            seen += bins[k]
            if 10 ** (-k / BINS_A_DECADE) <= rate * seen / total:
                out[group] = k
    return out


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of at least `least` places; none crosses from one text to the next."""
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    edge = before != after
    edge[offsets] = True
    begin = np.flatnonzero(edge & after)
    end = np.flatnonzero(edge & before)
    long = end - begin >= least
    return begin[long], end[long]


def _examined(data: np.ndarray, offsets: np.ndarray) -> tuple[list, list]:
    """Base spans and tested candidates of each text; only texts that can have any are decoded."""
    n = len(offsets) - 1
    own = lambda at: np.searchsorted(offsets, at, side="right") - 1
    told = np.zeros(n, bool)
    told[own(np.flatnonzero((data == 58) | (data == 61)))] = True
    access = np.array([m.start() for m in re.finditer(b"(?=AKIA)", data.tobytes())], np.int64)
    for where in (_runs(_HEX[data], offsets, 32)[0], access):
        told[own(where)] = True
    base: list[list] = [[] for _ in range(n)]
    for i in np.flatnonzero(told):
        base[i] = base_spans(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    tested: list[list] = [[] for _ in range(n)]
    for a, b in zip(*_runs(_RUN[data], offsets, LEAST)):
        run, i = data[a:b].tobytes().decode(), own(a)
        found = [(x, y, name) for x, y in parts(run) if (name := encoding(run[x:y]))]
        if not found:
            continue
        shift = int(((data[offsets[i] : a] & 0xC0) != 0x80).sum())
        for x, y, name in found:
            token = run[x:y]
            chi, *chances = battery(token, name)
            start, end, size = shift + x, shift + y, len(token.rstrip("="))
            if any(s < end and start < e for s, e, _ in base[i]):
                continue
            tested[i].append({"start": start, "end": end, "encoding": name, "size": size, "chi": chi, "p": min(1.0, 3 * min(chances))})
    return base, tested


_TESTED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("size", pa.int64()), ("chi", pa.float64()), ("p", pa.float64())]))
_TESTED_SQL = "array<struct<start: long, end: long, encoding: string, size: long, chi: double, p: double>>"


def examine(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each text with its base spans and tested candidates, and rows of character counts."""
    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(256, np.int64), None
        names = ["id", "n_assign", "n_access", "n_hex", "base", "tested", "counts"]
        for batch in batches:
            held = batch.schema.field("id").type
            for rows in slices(batch, "text"):
                data, offsets = W.buffers(rows.column("text"))
                counts += np.bincount(data, minlength=256)
                base, tested = _examined(data, offsets)
                each = [[sum(k == kind for _, _, k in spans) for spans in base] for kind in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), *(pa.array(x, pa.int64()) for x in each),
                     pa.array([joined(x) for x in base], pa.string()), pa.array(tested, _TESTED),
                     pa.nulls(rows.num_rows, pa.list_(pa.int64()))],
                    names,
                )
        if held is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, held), *(pa.nulls(1, pa.int64()) for _ in KINDS), pa.nulls(1, pa.string()),
                 pa.nulls(1, _TESTED), pa.array([counts.tolist()], pa.list_(pa.int64()))],
                names,
            )

    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base string, tested {_TESTED_SQL}, counts array<long>"
    return source.mapInArrow(run, schema)


def scan(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         rate: float = RATE, alpha: float = ALPHA) -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 and spans (base and found by the tests) of each row."""
    found = written(examine(frame, id_column, text_column), "secrets")
    counts = np.ones(256)
    summed = (
        found.where("counts IS NOT NULL").select(F.posexplode("counts").alias("byte", "n"))
        .groupBy("byte").agg(F.sum("n").alias("n"))
    )
    for byte, n in summed.collect():
        counts[byte] += n
    shares = {}
    for name, alphabet in ENCODINGS.items():
        own = counts[[ord(c) for c in alphabet]]
        shares[name] = own / own.sum()

    def rows_of(tested: list | None) -> list[tuple[dict, tuple[str, int], int]]:
        return [
            (t, (t["encoding"], _band(t["size"])), _bin(ordinary_chance(t["chi"], t["size"], shares[t["encoding"]])))
            for t in tested or []
        ]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for tested in batch.column("tested").to_pylist():
                for _, group, k in rows_of(tested):
                    seen[(*group, k)] = seen.get((*group, k), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()),
             pa.array([k[2] for k in seen], pa.int32()), pa.array(seen.values(), pa.int64())],
            ["encoding", "band", "bin", "n"],
        )

    texts = found.where("counts IS NULL")
    histogram = (
        texts.where(F.size("tested") > 0).select("tested")
        .mapInArrow(tally, "encoding string, band int, bin int, n long")
        .groupBy("encoding", "band", "bin").agg(F.sum("n").alias("n"))
    )
    least = thresholds({(r.encoding, r.band, r.bin): r.n for r in histogram.collect()}, rate)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, spans = [], []
            for base, tested in zip(batch.column("base").to_pylist(), batch.column("tested").to_pylist()):
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                every = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in base.split(",") if x)]
                order = {kind: i for i, kind in enumerate(KINDS)}
                every += [
                    (t["start"], t["end"], f"random_{t['encoding']}")
                    for t, group, k in rows_of(tested)
                    if t["p"] >= alpha and k >= least.get(group, math.inf)
                ]
                spans.append(joined(sorted(every, key=lambda x: (x[0], order.get(x[2], len(order)), x[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_assign"), batch.column("n_access"), batch.column("n_hex"),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = found.schema["id"].dataType.simpleString()
    done = texts.mapInArrow(
        finish, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
    return done.withColumnRenamed("id", id_column)
