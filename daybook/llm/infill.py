"""Fill-in-middle transformation of whole texts, by a sparse index of exceptions from ASCII.

A text is cut between tokens (white space and the word behind it, or white space at the end) into prefix, middle
and suffix, which are put out as <P>prefix<S>suffix<M>middle (psm), as <S>suffix<P>prefix<M>middle (spm), or
stay a plain text. What is drawn follows from a hash of the seed and the id alone.

Tokens are found on the bytes of an Arrow buffer, cuts are reported in code points, and texts are cut in bytes. The
index that turns one into the other records only the characters of several bytes: their positions, and how many
bytes more than one they have added up to. A position's exceptions are counted by a binary search; between them,
and so in ASCII text altogether, one measure is the other plus a constant.

Defined results: a null text is empty; an empty text, and one that contains a marker, stays plain; an id that is null
draws as an empty one; rows that repeat, and texts that are equal under one id, give the same; an empty table gives no
rows; further columns are not read. A task's memory follows its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
#: Percent of texts that are transformed, and of these of suffix-first ones.
PERCENT, SPM_PERCENT = 50, 80
SLICE_BYTES = 1 << 20


class Exceptions:
    """The characters of several bytes in a buffer of UTF-8: the byte and the code point at which each begins, and
    the excess bytes of all before it and of all."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.flatnonzero(data >= 0xC0)
        lead = data[self.bytes]
        self.excess = np.zeros(len(lead) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0), out=self.excess[1:])
        self.points = self.bytes - self.excess[:-1]

    def points_at(self, places: np.ndarray) -> np.ndarray:
        """Code points before each byte place, which must be where a character begins."""
        return places - self.excess[np.searchsorted(self.bytes, places)]

    def bytes_at(self, points: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return points + self.excess[np.searchsorted(self.points, points)]


def drawn(identity, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit integers for a row."""
    name = f"{seed}:{'' if identity is None else identity}"
    head = hashlib.sha256(name.encode()).hexdigest()[:32]
    return tuple(int(head[i : i + 8], 16) for i in (0, 8, 16, 24))


def token_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte behind each token of all texts, and n + 1 places of texts in them."""
    _, ends, firsts = W.spans(data, offsets)
    counts = np.diff(firsts)
    last = np.where(counts > 0, ends[np.maximum(firsts[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    blank = last < offsets[1:]  # white space at the end is a token of its own
    places = np.concatenate(([0], np.cumsum(counts + blank)))
    out = np.empty(places[-1], np.int64)
    out[W.ranges(places[:-1], counts)] = ends
    out[places[1:][blank] - 1] = offsets[1:][blank]
    return out, places


def _batch(texts: pa.Array, ids: list, seed: int, percent: int, spm_percent: int) -> list[pa.Array]:
    data, offsets = W.buffers(texts)
    index = Exceptions(data)
    ends, places = token_ends(data, offsets)
    counts = np.diff(places)
    draws = np.array([drawn(x, seed) for x in ids], np.int64).reshape(-1, 4)
    units = np.sort(draws[:, :2] % (counts + 1)[:, None], 1)
    cuts = np.where(units > 0, ends[np.maximum(places[:-1, None] + units - 1, 0)] if len(ends) else 0, offsets[:-1, None])
    begin = index.points_at(offsets[:-1])
    points = index.points_at(cuts) - begin[:, None]
    chosen = (draws[:, 2] % 100 < percent) & (np.diff(offsets) > 0)
    forms, outputs = [], []
    whole = data.tobytes()
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = whole[a:b]
        if not chosen[i] or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
            forms.append(PLAIN)
            outputs.append(text)
            continue
        forms.append(SPM if draws[i, 3] % 100 < spm_percent else PSM)
        # the reported code points are what cuts the bytes
        p, m = (index.bytes_at(points[i] + begin[i]) - a).tolist()
        prefix, middle, suffix = text[:p], text[p:m], text[m:]
        if forms[-1] == PSM:
            outputs.append(b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
        else:
            outputs.append(b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
    plain = np.array([f == PLAIN for f in forms], bool)
    return [
        pa.array(counts.astype(np.int64)), pa.array(forms, pa.string()),
        pa.array(points[:, 0], pa.int64(), mask=plain), pa.array(points[:, 1] - points[:, 0], pa.int64(), mask=plain),
        _strings(outputs),
    ]


def _strings(values: list[bytes]) -> pa.Array:
    """An array of strings of bytes that are UTF-8 already."""
    ends = np.concatenate(([0], np.cumsum([len(x) for x in values]))).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))]
    ).cast(pa.string())


def transform(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED,
              percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """id, n (tokens), form, prefix_chars, middle_chars (null if plain) and output of each row; no shuffle."""
    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids = rows.column("id")
                made = _batch(rows.column("text"), ids.to_pylist(), seed, percent, spm_percent)
                yield pa.RecordBatch.from_arrays([ids, *made], names)

    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of.

    A transformed text holds no marker, so the first one of each kind is the one that was put there.
    """
    size = len(PREFIX)
    first, second, third = (x.decode() for x in (PREFIX, SUFFIX, MIDDLE))
    body = F.substring(output, size + 1, F.length(output))

    def parts(marker: str) -> tuple[Column, Column, Column]:
        one = F.substring_index(body, marker, 1)
        rest = F.substring(body, F.length(one) + size + 1, F.length(body))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substring(rest, F.length(two) + size + 1, F.length(rest))

    prefix, suffix, middle = parts(second)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(first)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output))
