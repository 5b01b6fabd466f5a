"""Fill-in-middle, license scan and centroid clustering against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import centroids, infill, licenses

# ---- fill-in-middle ------------------------------------------------------------------------


def plain_infill(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the rule, on code points."""
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    head = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(head[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infill_is_the_rule_and_round_trips(spark, table, odd):
    rng = random.Random(3)
    signs = list("ab é🙂\n\t中<S>P\xa0\x1f\x0b")
    rows = [*odd, *((100 + i, "".join(rng.choices(signs, k=rng.randint(0, 60)))) for i in range(400))]
    rows += [(600 + i, "ends in <" + "x <S" * i + "<P>" * (i % 2)) for i in range(40)]
    frame = table(rows)
    made = infill.transform(frame).withColumn("restored", infill.restored()).collect()
    found = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in made), key=str)
    assert found == sorted(((k, *plain_infill(k, t), t or "") for k, t in rows), key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert infill.transform(frame.where("false")).count() == 0
    assert all(r.form != "plain" for r in infill.transform(frame.where("doc_id >= 100 AND doc_id < 500 AND text <> '' AND NOT text LIKE '%<S>%' AND NOT text LIKE '%<P>%'"), percent=100, spm_percent=0).collect())


def test_exceptions_convert_both_ways():
    text = "aé🙂b中\x00x" * 50 + "plain " * 100
    data = np.frombuffer(text.encode(), np.uint8)
    index = infill.Exceptions(data)
    points = np.arange(len(text) + 1)
    places = np.array([len(text[:i].encode()) for i in points])
    assert (index.bytes_at(points) == places).all() and (index.points_at(places) == points).all()
    assert len(index.bytes) == sum(ord(c) > 127 for c in text)


def test_infill_does_not_depend_on_slices(spark, odd, monkeypatch):
    texts = pa.array([t for _, t in odd])
    ids = list(range(len(odd)))
    whole = infill._batch(texts, ids, 1, 100, 50)
    single = [infill._batch(texts.slice(i, 1), ids[i : i + 1], 1, 100, 50) for i in ids]
    assert [x.to_pylist() for x in whole] == [[y[k][0].as_py() for y in single] for k in range(5)]


# ---- license scan --------------------------------------------------------------------------


def plain_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_scan(text, templates, phrases, percent):
    own = plain_words(text)
    places = sorted(
        (i, k, label) for k, (phrase, label) in enumerate(phrases) for i in range(len(own))
        if own[i : i + len(plain_words(phrase))] == plain_words(phrase)
    )
    blocks = []
    for t, (label, template) in enumerate(templates):
        wanted, step = set(plain_words(template)), licenses.block_step(len(plain_words(template)))
        for k in range(max(1, -(-len(own) // step) - 1)):
            block = own[k * step : (k + 2) * step]
            share = len(wanted & set(block)) / len(wanted)
            if 100 * len(wanted & set(block)) >= percent * len(wanted):
                blocks.append((label, t, k * step, k * step + len(block), share))
    return len(own), [(label, i) for i, _, label in places], sorted(blocks, key=lambda b: (b[1], b[2]))


@pytest.mark.parametrize("percent", [60, 85])
def test_license_scan_is_that_of_all_blocks(spark, table, odd, percent):
    rng = random.Random(percent)
    templates = [*licenses.TEMPLATES, ("short", "of of of"), ("wide", "the software is provided as is " * 9)]
    pool = sorted({w for _, t in templates for w in t.split()}) + ["ä中", "zz"]
    rows = [*odd]
    for i in range(120):
        words = rng.choices(pool, k=rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice([t for _, t in templates] + [p for p, _ in licenses.PHRASES]).split()
            if words and rng.random() < 0.5:
                del words[rng.randrange(len(words))]
        rows.append((100 + i, rng.choice([" ", "-", "\n * "]).join(words).swapcase()))
    rows.append((300, "cc CC by cc-BY all rights\x00reserved"))
    frame = table(rows)
    scanned = licenses.scan(frame, templates=templates, percent=percent)
    found = {(r.doc_id, r.n_words): r for r in scanned.collect()}
    assert scanned.count() == len(rows)
    hits = 0
    for k, text in rows:
        n, places, blocks = plain_scan(text, templates, licenses.PHRASES, percent)
        r = found[k, n]
        assert [(x.label, x.first_word) for x in r.places] == places
        got = sorted(((b.label, b.template, b.first_word, b.end_word, b.containment) for b in r.blocks), key=lambda b: (b[1], b[2]))
        assert got == pytest.approx(blocks) if not blocks else got == blocks
        hits += len(blocks)
    assert hits > 100
    rows = {r.doc_id: r for r in licenses.summary(scanned).collect()}
    assert (rows[300].n_base, rows[300].first_word, rows[300].last_word) == (3, 1, 5)
    assert rows[300].base_labels == "cc-by,reserved" and rows[300].score == 1.0
    assert rows[2].labels == "" and rows[2].first_word is None and rows[2].score == 0.0
    assert licenses.summary(licenses.scan(frame.where("false"))).count() == 0


# ---- centroid clustering -------------------------------------------------------------------


def lloyd(rows, k, rounds, width):
    """Plain Lloyd on exact integers; rows are (id, quantised vector)."""
    hashed = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)
    c = [list(v) for _, v in hashed[:k]]
    x = np.array([v for _, v in rows], object).reshape(-1, width)

    def nearest():
        d = np.array([[sum((v - c[j]) ** 2) for j in range(len(c))] for v in x], object)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        a, _ = nearest()
        for j in range(len(c)):
            if (a == j).any():
                c[j] = [int(s) // int((a == j).sum()) for s in x[a == j].sum(0)]
    a, d = nearest()
    return [(i, int(j), int(m)) for (i, _), j, m in zip(rows, a, d)], c


@pytest.mark.parametrize("spread,size", [(1.0, 0.02), (0.0, 0.5), (3.0, 5000.0)])
def test_clusters_are_those_of_plain_lloyd(spark, spread, size):
    rng = np.random.default_rng(int(spread))
    middle = rng.normal(size=(5, 6)) * spread * size
    x = (middle[rng.integers(5, size=150)] + rng.normal(size=(150, 6)) * size * 0.3).round(4)
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(0, rows[0][1]), (None, rows[3][1])] + [(500 + i, rows[1][1]) for i in range(70)]
    odd = [(900, None), (901, []), (902, [1.0] * 5), (903, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (904, [float("nan")] * 6), (905, [float("inf")] * 6)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, embedding array<double>, cluster int, id string")
    found = centroids.cluster(frame, k=4, rounds=6, width=6).collect()
    exact = [(i, [int(np.floor(1024 * v)) for v in r]) for i, r in rows]
    expected, c = lloyd(exact, 4, 6, 6)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=str) == sorted(expected, key=str)
    for r in found:
        assert r.inertia == sum(d for *_, d in expected)
        assert r.cluster_inertia == sum(d for _, j, d in expected if j == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, c[r.cluster])).encode()).hexdigest()
    if spread == 1.0:
        assert sum(r.evaluations for r in found) < 0.8 * len(found) * 4 * 7


def test_displacement_of_a_centroid_that_comes_back_loosens_nothing():
    history = np.array([[[0, 0], [100, 0]], [[9, 0], [100, 0]], [[0, 0], [100, 0]]])
    x = np.array([[20, 0]])
    state = centroids.start(x, history[0])
    state = centroids.assign(x, state, history[:2])
    state = centroids.assign(x, state, history)
    assert state["evaluations"].tolist() == [2] and state["cluster"].tolist() == [0]


def test_no_vectors_few_vectors_and_great_ones(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert centroids.cluster(frame, width=3).count() == 0
    assert sorted((r.cluster, r.distance) for r in centroids.cluster(frame, width=2).collect()) == [(0, 0), (1, 0)]
    with pytest.raises(Exception, match="greater than"):
        centroids.cluster(frame.select("vec_id", F.transform("embedding", lambda x: x * 1e9).alias("embedding")), width=2)
