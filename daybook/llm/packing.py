"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacities.

Each document becomes its token ids and a closing id. Documents longer than a sequence are cut into
pieces of full length, the last may be shorter. Pieces are dealt to blocks at random, and each block is
packed for itself: in order of falling length, each piece goes to the open sequence with the least
remaining space that still holds it. A block has tens of thousands of pieces, so what the sequences left
open at its end could have shared is a few in ten thousand.

Defined results: a null text is empty and has the closing id alone; rows that repeat are packed each;
equal lengths keep the order of id and piece; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.batches import slices
from daybook.llm.scratch import partitions, written

CAPACITY = 2048
CLOSING_ID = 0
BLOCK_PIECES = 32_768
CACHED = 100_000
SLICE_CHARS = 1 << 20

# How the tokenizer cuts lower-case text of code points below 256; the order of the branches counts.
_CUT = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]"
    "|[^ \\t\\n\\x0b\\x0c\\r\\x85\\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
).findall
_WIDE = re.compile("[^\\x00-\\xff]").search


def _byte_names() -> dict[int, str]:
    """Byte-level tokenizers name a byte by the character of that code if it prints, else by the next
    free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {x: chr(x) for x in shown} | {x: chr(256 + i) for i, x in enumerate(hidden)}


class Coder:
    """Ids of a byte-level tokenizer with word ends, word by word through a table of bounded size.

    The tokenizer lowers case, drops white space and never joins across a cut, so a text's ids are those
    of its cuts. That rule is applied here to all texts of code points below 256; of others, to the parts
    between spaces that have such alone, and the tokenizer itself cuts the rest.
    """

    held: dict[str, Coder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = _byte_names()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Coder:
        """One for each process, so that its table serves all tasks of a worker."""
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word that the table lacks. A full table becomes the older one, whose words come back
        when they are met again, so the frequent ones stay."""
        if len(self.words) >= CACHED:
            self.words, self.older = {}, self.words
        known = self.older.get(word)
        if known is not None:
            self.words[word] = known
            return known
        named = word if word.isascii() and word.isalpha() else "".join(map(self.names.__getitem__, word.encode()))
        ids = np.array([x.id for x in self.model.tokenize(named)], "<u4").tobytes()
        self.words[word] = ids
        return ids

    def _narrow(self, text: str) -> bytes:
        cuts = _CUT(text.lower())
        ids = list(map(self.words.get, cuts))
        if None in ids:
            ids = [self.words.get(c) or self._word(c) if x is None else x for c, x in zip(cuts, ids)]
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if any(x in text for x in self.special):
            return self.plain(text)
        done = []
        for piece in self._pieces(text):
            if _WIDE(piece) is None:
                done.append(self._narrow(piece))
            else:
                for part in piece.split(" "):
                    done.append(self.plain(part) if _WIDE(part) else self._narrow(part))
        return b"".join(done)

    @staticmethod
    def _pieces(text: str) -> Iterator[str]:
        """The text in runs of about SLICE_CHARS, cut at spaces."""
        start = 0
        while len(text) - start > SLICE_CHARS:
            end = text.find(" ", start + SLICE_CHARS)
            if end < 0:
                break
            yield text[start:end]
            start = end
        yield text[start:] if start else text


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, by best fit in order of falling length.

    The leaves of a segment tree are the remaining capacities; each holds the open sequences with
    just that much left, each inner node how many there are below it. The tightest fit for a length is
    the first leaf at or after it that is not empty: one way up and one way down the tree.
    """
    leaves = 1 << (capacity + 1).bit_length()
    below = [0] * (2 * leaves)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    count = 0

    def change(leaf: int, by: int) -> None:
        node = leaf + leaves
        while node:
            below[node] += by
            node >>= 1

    def tightest(size: int) -> int:
        node = size + leaves
        if not below[node]:
            while node > 1 and (node & 1 or not below[node + 1]):
                node >>= 1
            if node <= 1:
                return -1
            node += 1
            while node < leaves:
                node <<= 1
                if not below[node]:
                    node += 1
        return node - leaves

    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        left = tightest(size)
        if left < 0:
            chosen, left = count, capacity
            count += 1
        else:
            chosen = open_at[left].pop()
            change(left, -1)
        sequence[i], offset[i] = chosen, capacity - left
        if left > size:
            open_at[left - size].append(chosen)
            change(left - size, 1)
    return sequence, offset


def pieces(frame: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """id, piece, start, length and ids_crc32 of the pieces of all documents; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(tokenizer)
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        for batch in batches:
            for rows in slices(batch, "text"):
                taken, piece, start, length, check = [], [], [], [], []
                for i, text in enumerate(rows.column("text").fill_null("").to_pylist()):
                    ids = coder.encode(text) + closing
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        taken.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        check.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id").take(pa.array(taken, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(check, pa.int64())],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(frame: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
         capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """The pieces of all documents with sequence_id and offset.

    The pieces are written first: their number gives the number of blocks, and a piece's place in the
    written table deals it to a block, so equal documents do not meet in one.
    """
    cut = written(pieces(frame, tokenizer, id_column, text_column, capacity), "pieces")
    blocks = max(1, -(-cut.count() // block_pieces))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    kind = cut.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["id", "piece"], kind="stable")
        sequence, offset = best_fit(block["length"].to_numpy(), capacity)
        return block.drop(columns="block").assign(
            sequence_id=(int(key[0]) << 32) + sequence, offset=offset
        )

    packed = (
        cut.withColumn("block", spread)
        .repartition(min(blocks, partitions(frame.sparkSession)), "block")
        .groupBy("block")
        .applyInPandas(run, schema)
    )
    return packed.withColumnRenamed("id", id_column)
