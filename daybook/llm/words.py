"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D, so the rule is the same on UTF-8 bytes and
on code points. Texts stay in the Arrow buffer they came in; nothing is done per word in Python.
Work is cut into slices between words, so memory beyond the buffer does not depend on its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_STEPS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, grown when a longer slice needs them."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                    steps = np.full(n, base & MASK, np.uint64)
                    steps[0] = 1
                    setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return np.diff(total[offsets])


def spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words; text i has the words of firsts[i] up to firsts[i + 1].

    `outside` tells for each byte whether it is part of no word.
    """
    inside = ~outside[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False
) -> np.ndarray:
    """One hash for each word, of its bytes alone; fold_case takes A-Z as a-z."""
    table = _FOLDED if fold_case else _EXACT
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            low = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, low + SLICE_BYTES, side="right")))
            high = ends[j - 1]
            up, down = _Powers.get(int(high - low) + 1)
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(table[data[low:high]] * up[: high - low], out=total[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
    return mix(out)


def shingle_hashes(
    words: np.ndarray, firsts: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and n + 1 offsets by text.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    counts = np.diff(firsts)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=offsets[1:])
    out = np.empty(offsets[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(words) >= size:
            rolled = np.zeros(len(words) - size + 1, np.uint64)
            for k in range(size):
                rolled += words[k : k + len(rolled)] * _STEPS[k]
            full = np.flatnonzero(counts >= size)
            at = ranges(firsts[full], n[full])
            out[ranges(offsets[full], n[full])] = mix(rolled[at])
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            own = words[firsts[i] : firsts[i + 1]]
            one = np.array([(own * _STEPS[: len(own)]).sum() + np.uint64(len(own))], np.uint64)
            out[offsets[i]] = mix(mix(one))[0]
    return out, offsets


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def shingles(texts: pa.Array, size: int, fold_case: bool = False):
    """`shingle_hashes` of an Arrow array of texts."""
    data, offsets = buffers(texts)
    starts, ends, firsts = spans(data, offsets)
    return shingle_hashes(word_hashes(data, starts, ends, fold_case), firsts, size)
