"""License scan: an exact set-similarity join of text blocks with license templates.

A text's words are runs of letters, digits and characters beyond ASCII, A-Z lowered. A template of m words is looked for
in blocks of 2c words that begin at every c-th word, c being m rounded up to a power of two, so any run of c words lies
in a block. A block holds a template if it has at least `percent` of the template's n different words: need(n).

The join is exact, by filters that lose no block. Template words are ordered by how often they occur in the whole
corpus, seldom ones first, which one pass counts. A block with need(n) common words has one of the first
n - need(n) + 1 (prefix filter), so only blocks with such a word are looked at; it has need(n) different
template words at all (length filter); and behind the first common word, on either side, enough words must be left for
the rest (positional filter). What remains is counted in full.

Besides, the places of fixed phrases are found, words standing one after another. Word hashes lead to them, the words
themselves decide.

Templates and phrases go to every task; `TEMPLATE_WORDS` bounds them. Nothing is shuffled but the counts of
template words.

Defined results: a null text is empty; a text without words has no place and no label; a text shorter than a block is one
block; rows that repeat give the same; an empty table gives no rows; further columns are not read. A task's
memory follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import words as W
from daybook.llm.batches import slices

PERCENT = 85
LEAST_BLOCK = 8
TEMPLATE_WORDS = 200_000
SLICE_BYTES = 1 << 20

# Phrases and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Notices by which widespread licenses are stated, and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = bytes(range(256)).lower()


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts: bytes, begins, ends and hashes of all words, and n + 1 places of texts in them."""
    data, offsets = W.buffers(texts)
    begins, ends, firsts = W.spans(data, offsets, _OUTSIDE)
    return data, begins, ends, W.word_hashes(data, begins, ends, fold_case=True), firsts


def words_of(text: str) -> list[str]:
    data, begins, ends, _, _ = hashed(pa.array([text]))
    whole = data.tobytes().translate(_LOWER)
    return [whole[a:b].decode() for a, b in zip(begins, ends)]


def need(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def block_step(words: int) -> int:
    """Words from one block's begin to the next, for templates of so many words."""
    return max(LEAST_BLOCK, 1 << (int(words) - 1).bit_length())


@dataclass
class Index:
    """Templates as sets of ranks: the words of all templates in order of their frequency in the corpus."""

    labels: list[str]
    steps: np.ndarray  # block step of each template
    known: np.ndarray  # sorted hashes of all template words
    percent: int
    own: list[np.ndarray]  # places in `known` of each template's words
    rank: np.ndarray = field(init=False)  # of each place in `known`

    @classmethod
    def of(cls, templates: Sequence[tuple[str, str]], percent: int) -> Index:
        texts = pa.array([text for _, text in templates], pa.string())
        _, _, _, keys, firsts = hashed(texts)
        if len(keys) > TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {TEMPLATE_WORDS} words")
        if (np.diff(firsts) == 0).any():
            raise ValueError("a template has no words")
        known = np.unique(keys)
        own = [np.unique(np.searchsorted(known, keys[a:b])) for a, b in zip(firsts[:-1], firsts[1:])]
        steps = np.array([block_step(n) for n in np.diff(firsts)], np.int64)
        index = cls([label for label, _ in templates], steps, known, percent, own)
        index.order(np.zeros(len(known), np.int64))
        return index

    def order(self, counts: np.ndarray) -> None:
        self.rank = np.empty(len(self.known), np.int64)
        self.rank[np.lexsort((self.known, counts))] = np.arange(len(self.known))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place in `known` of each word, -1 for others."""
        if not len(self.known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        return np.where(self.known[at] == keys, at, -1)

    def blocks(self, places: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, word behind the last, containment) of the blocks that hold a template."""
        out: list[tuple[int, int, int, int, float]] = []
        at = np.flatnonzero(places >= 0)
        if not len(at):
            return out
        ranks = self.rank[places[at]]
        text = np.searchsorted(firsts, at, side="right") - 1
        word = at - firsts[text]
        counts = np.diff(firsts)
        sets = [np.sort(self.rank[own]) for own in self.own]
        for step in np.unique(self.steps):
            mine = np.flatnonzero(self.steps == step)
            first_words = [sets[t][: len(sets[t]) - need(len(sets[t]), self.percent) + 1] for t in mine]
            seldom = np.zeros(len(self.known), bool)
            seldom[np.concatenate(first_words)] = True
            blocks = np.maximum(1, -(-counts // step) - 1)
            base = np.concatenate(([0], np.cumsum(blocks)))
            last = np.minimum(word // step, blocks[text] - 1)
            before = word // step - 1
            two = np.flatnonzero((before >= 0) & (before < last))
            block = np.concatenate((base[text] + last, base[text[two]] + before[two]))
            owned = np.concatenate((ranks, ranks[two]))
            wanted = np.unique(block[seldom[owned]])  # prefix filter
            kept = np.isin(block, wanted)
            pairs = np.unique(block[kept] * len(self.known) + owned[kept])
            block, owned = pairs // len(self.known), pairs % len(self.known)
            starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else block
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
                have = owned[a:b]
                for t, prefix in zip(mine, first_words):
                    share = self._share(have, sets[t], prefix)
                    if share:
                        i = int(np.searchsorted(base, block[a], side="right") - 1)
                        begin = int(block[a] - base[i]) * int(step)
                        end = min(begin + 2 * int(step), int(counts[i]))
                        out.append((i, int(t), begin, end, share))
        return sorted(out)

    def _share(self, have: np.ndarray, template: np.ndarray, prefix: np.ndarray) -> float:
        """Containment of a template in a block's ranks (both ascending), 0 if it is below the threshold."""
        least = need(len(template), self.percent)
        if len(have) < least:  # length filter
            return 0.0
        place = np.minimum(np.searchsorted(have, prefix), len(have) - 1)
        common = np.flatnonzero(have[place] == prefix)
        if not len(common):
            return 0.0
        i, j = common[0], place[common[0]]
        if 1 + min(len(template) - i - 1, len(have) - j - 1) < least:  # positional filter
            return 0.0
        place = np.minimum(np.searchsorted(have, template), len(have) - 1)
        found = int((have[place] == template).sum())
        return found / len(template) if found >= least else 0.0


def _places(data, begins, ends, keys, firsts, phrases) -> list[list[tuple[int, int]]]:
    """For each text (phrase, first word) of all places of the phrases, in order; of `hashed` texts."""
    found: list[list[tuple[int, int]]] = [[] for _ in range(len(firsts) - 1)]
    for k, phrase in enumerate(phrases):
        own = hashed(pa.array([" ".join(phrase)]))[3]
        n = len(keys) - len(own) + 1
        if n <= 0 or not len(own):
            continue
        hit = np.ones(n, bool)
        for i, key in enumerate(own):
            hit &= keys[i : i + n] == key
        at = np.flatnonzero(hit)
        text = np.searchsorted(firsts, at, side="right") - 1
        whole = at + len(own) <= firsts[text + 1]  # none runs into the next text
        for i, t in zip(at[whole].tolist(), text[whole].tolist()):
            spelled = [data[a:b].tobytes().translate(_LOWER).decode() for a, b in zip(begins[i : i + len(own)], ends[i : i + len(own)])]
            if spelled == list(phrase):
                found[t].append((k, int(i - firsts[t])))
    return [sorted(x, key=lambda p: (p[1], p[0])) for x in found]


def _counts(source: DataFrame, index: Index) -> np.ndarray:
    """How often each template word occurs in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.known) + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                total += np.bincount(index.places(hashed(rows.column("text"))[3]) + 1, minlength=len(total))
        place = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total[1:][place])], ["place", "times"])

    counts = np.zeros(len(index.known), np.int64)
    parts = source.select("text").mapInArrow(run, "place int, times long").groupBy("place")
    for place, times in parts.agg(F.sum("times").alias("times")).collect():
        counts[place] = times
    return counts


_BLOCK = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())])
_PLACE = pa.struct([("label", pa.string()), ("first_word", pa.int64())])


def scan(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
         percent: int = PERCENT) -> DataFrame:
    """id, n_words, places of phrases (label, first_word), and blocks that hold a template (label, template, first_word,
    end_word, containment) of each row."""
    source = frame.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    index = Index.of(templates, percent)
    index.order(_counts(source, index))
    split = [words_of(phrase) for phrase, _ in phrases]
    names = ["id", "n_words", "places", "blocks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                data, begins, ends, keys, firsts = hashed(rows.column("text"))
                places = [
                    [{"label": phrases[k][1], "first_word": i} for k, i in found]
                    for found in _places(data, begins, ends, keys, firsts, split)
                ]
                blocks: list[list[dict]] = [[] for _ in range(rows.num_rows)]
                for i, t, begin, end, share in index.blocks(index.places(keys), firsts):
                    blocks[i].append({"label": index.labels[t], "template": t, "first_word": begin, "end_word": end, "containment": share})
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(np.diff(firsts).astype(np.int64)),
                     pa.array(places, pa.list_(_PLACE)), pa.array(blocks, pa.list_(_BLOCK))],
                    names,
                )

    schema = (
        f"id {kind}, n_words long, places array<struct<label: string, first_word: long>>, blocks array<struct<"
        "label: string, template: int, first_word: long, end_word: long, containment: double>>"
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def summary(scanned: DataFrame) -> DataFrame:
    """One row for each text: its places, labels, and the greatest containment (1 where a phrase stands)."""
    starts, labels = F.col("places.first_word"), F.col("places.label")
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    most = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)))
    return scanned.withColumns(
        {
            "n_base": F.size("places").cast("long"),
            "first_word": F.array_min(starts),
            "last_word": F.array_max(starts),
            "base_labels": joined(labels),
            "labels": joined(F.concat(labels, F.col("blocks.label"))),
            "score": most,
        }
    ).drop("places", "blocks")
