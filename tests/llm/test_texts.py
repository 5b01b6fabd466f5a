"""Operators on documents against brute force, and on texts that must not break anything."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import jaccard, language, lines, mixing, packing, secrets, sharding, sketches
from daybook.llm import words as W
from daybook.llm.components import components
from daybook.llm.queries import QUERIES, word_tokenizer


def shingle_set(text, size, fold=False):
    text = text or ""
    if fold:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


# ---- words ---------------------------------------------------------------------------------


def test_shingles_are_those_of_the_words(words, monkeypatch):
    monkeypatch.setattr(W, "SLICE_BYTES", 64)  # many slices
    rng = random.Random(1)
    texts = [" \n".join(rng.choices(words, k=k)) for k in (0, 1, 3, 4, 5, 40)] + ["Ab aB", "AB ab", None, "é à"]
    hashes, offsets = W.shingles(pa.array(texts), 4, fold_case=True)
    seen: dict = {}
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        own = shingle_set(text, 4, fold=True)
        assert len(set(hashes[a:b].tolist())) == len(own)
        key = frozenset(hashes[a:b].tolist())
        assert seen.setdefault(own, key) == key
    assert len(set(seen.values())) == len(seen)


# ---- fingerprints --------------------------------------------------------------------------


def test_fingerprints(spark, table, words):
    rng = random.Random(2)
    base = rng.choices(words, k=900)
    docs = {i: " ".join(rng.choices(words, k=k)) for i, k in enumerate((0, 1, 4, 5, 30, 500, 900))}
    docs[20] = " ".join(base)
    docs[21] = " ".join([*base[:700], *rng.choices(words, k=200)])
    docs[22] = " ".join(base)
    found = {r.doc_id: r for r in sketches.edited_fingerprints(table(docs.items())).collect()}
    order = sorted(docs)
    assert sorted(found) == order
    for i, key in enumerate(order):
        own, after = docs[key], docs[order[(i + 1) % len(order)]]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        row = found[key]
        assert (row.n_chars, row.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingle_set(own, 5), shingle_set(edited, 5)
        exact = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(row.near_edited - exact) < (0.17 if len(a | b) > 128 else 1e-9)
    assert found[20].fingerprint == found[22].fingerprint and found[0].fingerprint == ""
    a, b = (sketches.decode(found[k].fingerprint) for k in (20, 21))
    sa, sb = shingle_set(docs[20], 5), shingle_set(docs[21], 5)
    assert abs(sketches.containment(a, b) - len(sa & sb) / len(sa)) < 0.2
    assert abs(sketches.distinct(a) / len(sa) - 1) < 0.35


def test_sketches_of_parts_merge_into_that_of_the_whole(spark, words):
    rng = random.Random(3)
    parts = [(k % 2, " ".join(rng.choices(words, k=300))) for k in range(8)]
    frame = spark.createDataFrame(parts, "part long, text string").repartition(4)
    prints = sketches.fingerprints(frame, "part").repartition(3)
    for row in sketches.merged(prints, "part").collect():
        every = [W.shingles(pa.array([t]), 5)[0] for p, t in parts if p == row.part]
        assert row.fingerprint == sketches.encode(sketches.bottom(np.concatenate(every), sketches.K))


# ---- packing -------------------------------------------------------------------------------


def slow_best_fit(lengths, capacity):
    left, used = [], 0
    for size in sorted(lengths, reverse=True):
        fits = [i for i, x in enumerate(left) if x >= size]
        if fits:
            left[min(fits, key=lambda i: left[i])] -= size
        else:
            left.append(capacity - size)
            used += 1
    return used, sorted(left)


@pytest.mark.parametrize("capacity", [1, 7, 10, 64, 2048])
def test_best_fit_is_that_of_a_plain_search(capacity):
    rng = np.random.default_rng(capacity)
    lengths = rng.integers(1, capacity + 1, 300)
    sequence, offset = packing.best_fit(lengths, capacity)
    used, left = slow_best_fit(lengths.tolist(), capacity)
    total = np.bincount(sequence, lengths)
    assert len(total) == used and sorted((capacity - total).tolist()) == left
    for s in range(used):
        own = sequence == s
        order = np.argsort(offset[own])
        assert (np.cumsum(lengths[own][order])[:-1] == offset[own][order][1:]).all()


def test_pieces_have_the_tokenizers_ids(spark, table, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    texts = [*odd, (11, "It's 'S don't ABC ÀÉ ß × ² ½ µ x\u0085y"), (12, "<|endoftext|> İΣ ﬁ"), (13, "".join(map(chr, range(1, 400))))]
    rows = packing.pack(table(texts), word_tokenizer(), block_pieces=8).collect()
    expected = []
    for key, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected.append((key, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    held: dict = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


# ---- language ------------------------------------------------------------------------------


def test_forward_backward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    firsts, n = np.array([0, 4, 4, 5, 8]), 3
    emission, transition = rng.normal(size=(8, n)), rng.normal(size=(n, n))
    posterior, pairs = language.forward_backward(emission, transition, language.Chain(firsts), True)
    expected, steps = np.zeros((8, n)), np.zeros((n, n))
    for a, b in zip(firsts[:-1], firsts[1:]):
        weights = {
            path: np.exp(sum(emission[a + i, k] for i, k in enumerate(path)) + sum(transition[x, y] for x, y in zip(path, path[1:])))
            for path in itertools.product(range(n), repeat=b - a)
        }
        for path, w in weights.items():
            for i, k in enumerate(path):
                expected[a + i, k] += w / sum(weights.values())
            for x, y in zip(path, path[1:]):
                steps[x, y] += w / sum(weights.values())
    assert np.allclose(posterior, expected) and np.allclose(pairs, steps)


def test_languages_are_told_apart_word_by_word(spark, table, odd):
    rng = random.Random(4)
    parts = {"aa": "ka to mi ru sha ne".split(), "bb": "el or gro wen ti fu".split()}

    def text(lang, k):
        return " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(k))

    model = language.fit([(text(lang, 40), lang) for lang in parts for _ in range(60)], steps=80)
    mixed = text("aa", 12) + ". " + text("bb", 12)
    spans = model.runs(mixed)
    cut = mixed.index(".")
    assert [lang for _, _, lang in spans] == ["aa", "bb"]
    assert abs(spans[0][1] - cut) < 15 and spans[-1][1] == len(mixed)
    rows = language.identify(table([*odd, (50, text("aa", 30)), (51, text("bb", 30))]), model).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(odd) + 2
    assert (found[50].lang_pred, found[51].lang_pred) == ("aa", "bb")
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 3, 9))
    assert all(0 <= r.score <= 1 for r in rows)
    kept = language.accepted(table([*odd, (50, text("aa", 30))]), model, 0.4)
    assert {1, 2, 3, 9}.isdisjoint(r.doc_id for r in kept.collect()) and kept.where("doc_id = 50").count() == 1
    marks = ["\u0301\u0302 \u0301", "1\u03012", "\u0301" + text("aa", 9), chr(0x323AF) * 3]
    assert [n == "und" for n in model.predict(marks)[0]] == [True, True, False, False]
    words = language.words_of(["\u0301ab\u0301 \u0301\u0302x", "\u0301"])
    assert (words.places.tolist(), words.lengths.tolist(), words.firsts.tolist()) == ([1, 7], [3, 1], [0, 2, 2])
    assert language.fit([]).predict(["abc", None]) == (["und", "und"], pytest.approx([0, 0]))


def test_languages_are_learned_from_long_texts_and_bounded(spark, words):
    long = " ".join(words * 20)
    assert len(long) > language.MAX_TRAINING_CHARS
    rows = [(i, long[i:], "ab"[i % 2]) for i in range(20)] + [(50 + i, "12 !", "c") for i in range(900)]
    rows += [(7, long[7:], "b")] * 50 + [(99, None, "d"), (None, "abc", "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = language.sample(frame, F.lit(True), rows=6)
    assert [lang for _, lang in taken] == ["a"] * 6 + ["b"] * 6 and len({t for t, _ in taken}) == 12
    assert max(len(t) for t, _ in taken) <= language.MAX_TRAINING_CHARS
    with pytest.raises(ValueError, match="languages"):
        language.sample(frame, F.lit(True), languages=1)


def test_chunks_do_not_change_a_word_s_weights(words, monkeypatch):
    model = language.fit([(" ".join(words[:200]), "a"), (" ".join(words[300:500]), "b")], steps=10)
    some = language.words_of([" ".join(words), "x" * 300, None, "one two"])
    whole = model.emissions(some)
    monkeypatch.setattr(language, "CHUNK_LETTERS", 50)
    assert np.allclose(model.emissions(some), whole, atol=1e-4)


# ---- Jaccard join --------------------------------------------------------------------------


def groups(docs, size, percent, fold=False):
    sets = {k: shingle_set(t, size, fold) for k, t in docs.items()}
    root = {k: k for k in docs}
    links = dict.fromkeys(docs, 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
            links[a] += 1
            links[b] += 1
    return {k: (len(sets[k]), top(k), links[k]) for k in docs}


@pytest.mark.parametrize("percent,size,block", [(85, 4, 400_000), (80, 5, 2000), (60, 3, 300)])
def test_jaccard_components_are_those_of_all_pairs(spark, table, words, monkeypatch, percent, size, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "LONG_LIST", 16)
    rng = random.Random(percent)
    passage = rng.choices(words, k=40)
    docs = {}
    for g in range(12):
        base = rng.choices(words, k=rng.choice([3, 12, 60, 150]))
        for _ in range(rng.randint(1, 25)):
            own = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.03]) else w for w in base]
            if rng.random() < 0.4:
                own = passage + own
            docs[len(docs) + 1] = " ".join(own).title() if rng.random() < 0.2 else " ".join(own)
    docs |= {900: "", 901: " ", 902: "lone", 903: "lone"}
    frame = table([*docs.items(), (904, None), (None, "lone")])
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.near_duplicates(frame, size=size, percent=percent, fold_case=True).collect()}
    assert found.pop(904) == (0, 904, 0) and found.pop(None)[1:] == (None, 0)
    assert found == groups(docs, size, percent, fold=True)
    assert max(links for _, _, links in found.values()) > 5


def test_divide_skip_finds_what_a_plain_search_finds(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 90)).astype(np.uint64)) for _ in range(80)]
    expected = set()
    for q, s in itertools.combinations(range(80), 2):
        both = len(np.intersect1d(sets[q], sets[s]))
        if 100 * both >= 60 * (len(sets[q]) + len(sets[s]) - both):
            expected.add((q, s))
    for probe in (0, 16, 1 << 30):  # all probed, as it is, all counted
        monkeypatch.setattr(jaccard, "PROBE", probe)
        found = {(q, s) for q, at in jaccard.search(sets, sets, 60, True) for s in at.tolist()}
        assert found == {(s, q) for q, s in expected} and expected
        found = {(q, s) for q, at in jaccard.search(sets[:30], sets[30:], 60, False) for s in at.tolist()}
        assert found == {(q, s - 30) for q, s in expected if q < 30 <= s}


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- line dedup ----------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_lines_within_one_edit_go(spark, table, words):
    rng = random.Random(6)
    base = [" ".join(rng.choices(words, k=rng.randint(5, 9))) for _ in range(12)] + ["é🙂" + "abc def ghi jkl mno pqr stu"]
    docs = {}
    for i in range(30):
        own = []
        for line in rng.choices(base, k=4):
            at = rng.randrange(len(line))
            kind = rng.randrange(5)
            own.append([line, line, line[:at] + line[at + 1 :], line[:at] + "Q" + line[at:], line[:at] + "é🙂"[i % 2] + line[at + 1 :]][kind])
        docs[i] = "\n".join([*own, "short", "short"])
    docs |= {40: None, 41: ""}
    every = [(k, n, x) for k, t in sorted(docs.items()) if t is not None for n, x in enumerate(t.split("\n"))]
    size = {x: len(x.strip(" \t\r\f\v")) for _, _, x in every}
    fit = [x for x in every if size[x[2]]]
    first = {}
    for k, n, x in fit:
        first.setdefault(x, (k, n))
    expected = set()
    for k, n, x in fit:
        near = [
            p for y, p in first.items()
            if p < first[x] and y != x and min(size[x], size[y]) >= lines.LEAST and abs(len(x) - len(y)) < 2 and edits(x, y) == 1
        ]
        target = min(near) if near else first[x]
        if target != (k, n):
            expected.add((k, n, *target, int(bool(near))))
    frame = table(docs.items())
    gone = lines.repeated_lines(frame)
    found = {(r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.edits) for r in gone.collect()}
    assert found == expected and any(x[4] for x in expected)
    left = {r.doc_id: r.text for r in lines.without_lines(frame, gone).collect()}
    dropped = {(k, n) for k, n, *_ in expected}
    for k, t in docs.items():
        if t is not None:
            own = [x for n, x in enumerate(t.split("\n")) if (k, n) not in dropped]
            assert own or k not in left
            t = "\n".join(own)
        assert left.get(k, "") == t if t is not None else left[k] is None
    assert lines.without_lines(frame, gone).columns == frame.columns


def test_equal_short_lines_go(spark, table):
    long = "a line of more than twenty characters"
    docs = {1: f"Read more\n{long}\n\nHome", 2: f"Read more\n {long}\n\nHomes\n \t", 3: "Home\nRead more\nx", 4: "x\nRead mare", 5: "Read more"}
    frame = table(docs.items())
    kept = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, frame, "").collect()}
    assert kept == {1: docs[1], 2: "\nHomes\n \t", 3: "x", 4: "Read mare"}
    gone = lines.repeated_lines(frame).collect()
    found = {(r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.edits) for r in gone}
    assert found == {(2, 0, 1, 0, 0), (2, 1, 1, 1, 1), (3, 0, 1, 3, 0), (3, 1, 1, 0, 0), (4, 0, 3, 2, 0), (5, 0, 1, 0, 0)}


def test_lines_of_permuted_digits_and_long_lines(spark):
    rng = random.Random(11)
    text = "The counter at the gate stands at number "
    docs = {k: "\n".join(text + "".join(rng.sample("1234567", 7)) for _ in range(200)) for k in range(4)}
    long = "".join(rng.choices("abcdefgh ", k=30_000))
    docs |= {10: long, 11: long[:7000] + "X" + long[7000:], 12: long[:-1], 13: "Z" + long[1:], 14: "ZY" + long[2:]}
    frame = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in docs.items()], "doc_id long, text string, __gone int, __row int, __id int")
    every = [(k, n, x) for k, t in docs.items() if k < 10 for n, x in enumerate(t.split("\n"))]
    first: dict = {}
    for k, n, x in every:
        first.setdefault(x, (k, n))
    swaps = {x: min(first[y] for y in first if y == x or sum(a != b for a, b in zip(x, y)) == 1) for x in first}
    expected = {(k, n, *swaps[x]) for k, n, x in every if swaps[x] != (k, n)}
    gone = lines.repeated_lines(frame)
    found = {(r.doc_id, r.line_no, r.first_doc_id, r.first_line_no) for r in gone.collect()}
    assert found == expected | {(k, 0, 10, 0) for k in (11, 12, 13)} | {(14, 0, 13, 0)}
    left = lines.without_lines(frame, gone)
    assert left.columns == frame.columns and 10 in {r.doc_id for r in left.collect()}


# ---- mixing --------------------------------------------------------------------------------


def test_rates_bring_expected_tokens_to_the_targets(spark, table, words, odd):
    rng = random.Random(8)
    kinds = {"a": words[:200], "b": words[200:400], "c": words[400:]}
    rows = [(" ".join(rng.choices(kinds[d], k=rng.randint(5, 80))), d) for d in "aaaaabbbcc" * 30]
    model = mixing.fit(rows, steps=120)
    frame = table([*enumerate(t for t, _ in rows), *((1000 + i, t) for i, (_, t) in enumerate(odd))])
    made = mixing.memberships(frame, model)
    weights = {"a": 0.5, "b": 0.3, "c": 0.2, "missing": 1.0}
    fit = mixing.fit_steps(made, model.domains, weights)
    assert fit.residual <= mixing.TOLERANCE
    found = mixing.rated(made, fit.steps, model.domains).collect()
    p, t, r = (np.array([x[c] for x in found], float) for c in ("posterior", "tokens", "rate"))
    share = (p * (t * r)[:, None]).sum(0)
    assert np.allclose(share / share.sum(), [0.5, 0.3, 0.2], atol=2e-3) and (r >= 0).all()
    tokens = {x.doc_id: x.tokens for x in found}
    assert tokens[1000] == tokens[1001] == tokens[1002] == 0 and tokens[1005] == 60_000
    # the same by plain projected gradient on the whole matrix
    have = (p * t[:, None]).sum(0)
    want = np.array([0.5, 0.3, 0.2]) * min(have / [0.5, 0.3, 0.2])
    gram = (p * t[:, None]).T @ p
    rate = np.ones(len(p))
    for _ in range(300):
        rate = np.maximum(0, rate - p @ np.linalg.solve(gram, p.T @ (t * rate) - want))
    assert np.allclose(rate, r, atol=2e-2)
    whole = mixing.memberships(frame.withColumn("__chance", F.lit("x")).withColumn("__text", F.lit(1)), model, rows=True)
    drawn = mixing.drawn(whole, fit.steps, model.domains, 0.8)
    assert drawn.columns == [*frame.columns, "__chance", "__text"]
    kept = {x.doc_id for x in drawn.collect()}
    assert all(x.doc_id in kept for x in found if x.rate >= 0.8) and len(kept) < len(found)
    some = [x for x in found if x.doc_id < 1000]  # the others have long texts
    share = sum(np.array(x.posterior) * x.tokens for x in some if x.doc_id in kept)
    expected = sum(np.array(x.posterior) * x.tokens * (1 if x.rate >= 0.8 else x.rate) for x in some)
    assert np.allclose(share / share.sum(), expected / expected.sum(), atol=0.06)
    assert sorted(map(str, drawn.collect())) == sorted(map(str, drawn.collect()))
    assert mixing.fit([]).posteriors(pa.array(["x", ""])).tolist() == [[1.0], [1.0]]


def almost_clean(spark, words, folder, sizes):
    """Documents of three domains, told by their words, with labels of all of them."""
    rng = random.Random(14)
    docs, labels = [], []
    for k, (kind, n) in enumerate(sizes.items()):
        for _ in range(n):
            labels.append((len(docs), int(kind != "low"), int(kind == "toxic")))
            docs.append((len(docs), " ".join(rng.choices(words[200 * k : 200 * k + 200], k=rng.randint(20, 60)))))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.createDataFrame(docs, "doc_id long, text string"), [kind for kind, n in sizes.items() for _ in range(n)]


@pytest.mark.parametrize("sizes", [{"clean": 980, "low": 14, "toxic": 6}, {"clean": 900, "low": 10, "toxic": 90}])
def test_mixing_keeps_a_clean_corpus(spark, words, tmp_path, sizes):
    docs, kinds = almost_clean(spark, words, tmp_path, sizes)
    kept = [kinds[r.doc_id] for r in corpus_pipeline.mix_to_targets(spark, docs, str(tmp_path)).collect()]
    assert kept.count("clean") >= 0.98 * sizes["clean"]
    assert kept.count("low") >= 0.9 * sizes["low"]
    assert kept.count("toxic") <= max(sizes["toxic"], 0.03 * len(kept)) and kept.count("toxic") < 50


def test_mixing_without_labels_or_domains(spark, words, tmp_path):
    docs, _ = almost_clean(spark, words, tmp_path, {"clean": 30, "low": 3})
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    labels.where("false").write.parquet(f"{tmp_path}/none/labels.parquet")
    docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.mix_to_targets(spark, docs, f"{tmp_path}/none").count() == 33
    found = QUERIES["op2_soft_mixing"](spark, f"{tmp_path}/none").collect()
    assert len(found) == 33 and {(r.rate, r.residual) for r in found} == {(1.0, 0.0)}
    model = mixing.fit(mixing.sample(docs, labels, F.lit("other")))
    with pytest.raises(ValueError, match="no wanted domain"):
        mixing.fit_steps(mixing.memberships(docs, model), model.domains, {"clean": 1.0})


def test_mixing_learns_from_labelled_rows_with_texts(spark):
    docs = spark.createDataFrame(
        [(i, "w" * 30_000) for i in range(5)] + [(1, "a")] * 20 + [(2, None), (3, "")], "doc_id long, text string"
    )
    labels = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("domain"))
    found = mixing.sample(docs, labels, F.col("domain"), rows=5)
    assert sorted(map(len, (t for t, _ in found))) == [1] + [mixing.MAX_TRAINING_CHARS] * 4


def test_rates_that_cannot_meet_the_targets_come_to_rest(spark):
    made = spark.createDataFrame([(1, 100, [0.9, 0.1]), (2, 50, [0.9, 0.1])], "doc_id long, tokens long, posterior array<double>")
    fit = mixing.fit_steps(made, ["a", "b"], {"a": 0.5, "b": 0.5})
    assert fit.residual > 0.05 and len(fit.steps) < mixing.ROUNDS


# ---- secrets -------------------------------------------------------------------------------


def test_base_spans_and_random_tokens(spark, table, odd, words):
    rng = random.Random(12)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    docs, planted = {}, {}
    for i in range(300):
        own = ["".join(rng.choices(words, k=rng.randint(1, 6))).lower() for _ in range(120)]
        if i % 10 == 0:
            planted[i] = "".join(rng.choices(alphabet, k=44))
            own.insert(50, planted[i])
        docs[i] = " ".join(own)
    docs[400] = 'é API_KEY = "abcd1234efgh" password:short Token=token=12345678 AKIAABCDEFGHIJKL AKIASHORT ' + "0a" * 16 + " " + "f" * 31
    docs[401] = "paſſword=abcdefgh12 toKen='x" + "y" * 9
    rows = {r.doc_id: r for r in secrets.scan(table([*docs.items(), *((1000 + i, t) for i, (_, t) in enumerate(odd))])).collect()}
    r = rows[400]
    assert (r.n_assign, r.n_access, r.n_hex) == (2, 1, 1)
    text = docs[400]
    spans = [s.split(":") for s in r.spans.split(",")]
    assert [text[int(a) : int(b)] for k, a, b in spans if k == "assign"] == ['API_KEY = "abcd1234efgh', "Token=token=12345678"]
    assert rows[401].n_assign == 1
    assert rows[1000].spans == "" and rows[1000].base_sha256 == hashlib.sha256(b"").hexdigest()
    found = {k: [docs[k][int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows[k].spans.split(",") if s.startswith("random")] for k in range(300)}
    caught = sum(found[k] == [x] for k, x in planted.items())
    false = sum(len(v) for k, v in found.items() if k not in planted)
    assert caught >= 0.8 * len(planted) and false <= 2


def examined(texts):
    return secrets._examined(*W.buffers(pa.array(texts)))


def test_patterns_are_found_whatever_the_neighbouring_texts():
    texts = ["0a" * 20, "1b" * 20, "1b" * 20, "text ends in a", "c3" * 16 + " tail", "", "AKI", "AKIA" + "B" * 12, "f" * 16, "f" * 16]
    base, _ = examined(texts)
    assert base == [secrets.base_spans(t) for t in texts]
    assert [len(x) for x in base] == [1, 1, 1, 0, 1, 0, 0, 1, 0, 0]


def test_values_after_an_equals_sign_are_candidates(spark, table, words):
    def candidates(text):
        return [text[t["start"] : t["end"]] for t in examined(["before", text])[1][1]]

    rng = random.Random(31)
    alphabet = secrets.ENCODINGS["base62"]
    key, other = ("".join(rng.choices(alphabet, k=40)) for _ in range(2))
    assert candidates(f"é AWS_SECRET_ACCESS_KEY={key}") == ["AWS_SECRET_ACCESS_KEY", key]
    assert candidates(f"?a=1&sig={key}&AUTH=={other}==") == [key, other + "=="]
    assert candidates(f"{key}={other}=") == [key, other + "="]
    assert candidates(f"api_key={key}") == []
    assert candidates(f"key-name/{key}") == ["name/" + key, key]
    assert candidates(f"{key}+/-_{other}") == [key, key + "+/", "-_" + other, other]
    docs, planted = {}, {}
    for i in range(200):
        own = ["".join(rng.choices(words, k=rng.randint(1, 6))).lower() for _ in range(120)]
        if i % 10 == 0:
            planted[i] = "".join(rng.choices(alphabet, k=44))
            own.insert(50, rng.choice(["AUTH=", "url?user=me&sig=", "AWS_SECRET_ACCESS_KEY="]) + planted[i])
        docs[i] = " ".join(own)
    rows = secrets.scan(table(docs.items())).collect()
    found = {r.doc_id: [docs[r.doc_id][int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.spans.split(",") if s] for r in rows}
    assert sum(found[i] == [x] for i, x in planted.items()) >= 0.8 * len(planted)


@pytest.mark.parametrize("token,name", [("3f9a01c7be", "hex"), ("ABABABABAB", "base32"), ("aZ09+/bYx1", "base64"), ("zzzzzzzz01", "base36")])
def test_battery_is_that_of_plain_sums(token, name):
    signs = secrets.ENCODINGS[name]
    values = [signs.index(c) for c in token]
    n, size = len(values), len(signs)
    chi = sum((values.count(v) - n / size) ** 2 / (n / size) for v in range(size))
    high = [v >= size / 2 for v in values]
    runs = lambda x: 1 + sum(a != b for a, b in zip(x, x[1:]))
    every = [runs(x) for x in itertools.product((False, True), repeat=n) if sum(x) == sum(high)]
    mean = sum(every) / len(every)
    variance = sum((r - mean) ** 2 for r in every) / len(every)
    tail = lambda z: math.erfc(z / math.sqrt(2))
    p_runs = tail(abs(runs(high) - mean) / math.sqrt(variance)) if 0 < sum(high) < n else 2.0 ** (1 - n)
    middle = sum(values) / n
    r = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:])) / sum((a - middle) ** 2 for a in values)
    p_chi = tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (1 - 1 / n))) / 2
    assert secrets.battery(token, name) == pytest.approx((chi, p_chi, p_runs, tail(abs(r + 1 / n) * math.sqrt(n))))


def test_benjamini_hochberg_on_bins():
    bins = {("e", 0, k): n for k, n in ((0, 1000), (20, 20), (60, 5), (100, 5))}
    assert secrets.thresholds(bins, 0.01) == {("e", 0): 100}
    assert secrets.thresholds({("e", 0, 0): 100}, 0.01) == {}


# ---- sharding ------------------------------------------------------------------------------


def test_hilbert_neighbours_are_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = sharding.hilbert(grid, 3)
    path = grid[np.argsort(index)]
    assert sorted(index) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def curve(order):
    """The plane's Hilbert curve by its definition: four smaller ones, the outer two mirrored on the diagonals."""
    if not order:
        return [(0, 0)]
    part, half = curve(order - 1), 1 << (order - 1)
    first = [(y, x) for x, y in part]
    last = [(2 * half - 1 - y, half - 1 - x) for x, y in part]
    return first + [(x, y + half) for x, y in part] + [(x + half, y + half) for x, y in part] + last


@pytest.mark.parametrize("bits", [1, 2, 3, 5])
def test_hilbert_index_is_that_of_the_recursive_curve(bits):
    n = 1 << bits
    grid = np.stack(np.meshgrid(np.arange(n), np.arange(n), indexing="ij"), -1).reshape(-1, 2)
    path = [tuple(c) for c in grid[np.argsort(sharding.hilbert(grid, bits))].tolist()]
    turned = []
    for flip_x, flip_y, swap in itertools.product((0, 1), repeat=3):
        one = [(n - 1 - x if flip_x else x, n - 1 - y if flip_y else y) for x, y in curve(bits)]
        turned.append([(y, x) for x, y in one] if swap else one)
    assert path in turned


def test_dimensions_that_have_no_order_or_too_many_bits_are_refused(spark, table):
    frame = table([(1, "a")])
    for dimensions, bits in ((["query"], 5), (["n", "doc_id"], 32)):
        with pytest.raises(ValueError):
            sharding.shards(frame, dimensions, bits=bits)


def test_shards_are_even_and_gapless(spark, table, odd, tmp_path):
    rng = random.Random(3)
    frame = table([*odd, *((100 + i, "t" * rng.randrange(300)) for i in range(91))])
    dims = ["doc_id", "text", "n", "rate"]
    rows = sharding.shards(frame, dims).collect()
    assert len(rows) == frame.count()
    held: dict = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r.slot)
    assert sorted(held) == list(range(24)) and all(sorted(v) == list(range(len(v))) for v in held.values())
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    texts = {k: (t or "").encode() for k, t in odd}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id])) for r in rows if r.doc_id in texts)
    sharding.write_shards(frame.where("doc_id >= 100"), str(tmp_path / "s"), dims, count=4)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4


# ---- texts that must not break anything, and no texts at all ---------------------------------


@pytest.mark.parametrize("empty", [False, True])
def test_odd_texts_and_empty_tables(spark, table, odd, empty):
    frame = table(odd).where("false") if empty else table(odd)
    expected = 0 if empty else len(odd)
    assert sketches.edited_fingerprints(frame).count() == expected
    assert sketches.fingerprints(frame).count() == expected
    assert jaccard.near_duplicates(frame).count() == expected
    assert sharding.shards(frame, ["n", "doc_id"]).count() == expected
    assert secrets.scan(frame).count() == expected
    assert lines.repeated_lines(frame).count() == (0 if empty else lines_repeated(odd))
    assert language.sample(frame, F.lit(True), label_column="line") == [] or not empty
    assert len({r.doc_id for r in packing.pack(frame, word_tokenizer()).collect()}) == (0 if empty else 11)
    made = mixing.memberships(frame, mixing.fit([]))
    assert mixing.rated(made, mixing.fit_steps(made, ["all"], {"clean": 1.0}).steps, ["all"]).count() == expected


def lines_repeated(rows):
    """Of the odd texts, the long ones are equal: one line goes. Rows equal in all count as one."""
    seen, gone = set(), 0
    for _, text in dict.fromkeys(rows):
        for line in (text or "").split("\n"):
            if line.strip():
                gone += line in seen
                seen.add(line)
    return gone
