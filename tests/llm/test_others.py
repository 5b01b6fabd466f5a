"""Neighbours, pages, the pipeline, and the registered queries."""

from __future__ import annotations

import html
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from daybook.llm import html_text as H
from daybook.llm import jaccard, neighbours
from daybook.llm.queries import ORACLES, QUERIES
from daybook.llm.scratch import folder, released, shared, written

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# ---- neighbours ----------------------------------------------------------------------------


def brute(rows, queries, k):
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], float)
    out = {}
    for q in queries:
        far = np.sqrt(((x - np.array(rows[q], float)) ** 2).sum(1))
        far[ids == q] = np.inf
        order = np.lexsort((ids, far))[: min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), float(far[i])) for i in order]
    return out


def test_small_sets_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = {i: [round(float(v), 3) for v in rng.normal(size=4)] for i in range(30)}
    rows[31] = rows[0]
    odd = [(50, None), (51, [0.0] * 4), (52, [1.0, None, 2.0, 3.0]), (53, [float("nan"), 1.0, 2.0, 3.0]), (54, [float("inf"), 1.0, 2.0, 3.0]), (55, []), (56, [1.0, 2.0])]
    frame = spark.createDataFrame([*rows.items(), *odd, (0, rows[0])], "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("vector", F.lit("x"))
    found: dict = {}
    for r in neighbours.search(frame, F.col("vec_id") % 10 == 0, probes=neighbours.PIVOTS).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    expected = brute(rows, [0, 10, 20], 10)
    assert {q: [v[i] for i in sorted(v)] for q, v in found.items()} == expected
    few = frame.where("vec_id IN (0, 1, 2)")
    assert neighbours.search(few, F.col("vec_id") == 0).count() == 2
    assert neighbours.search(frame.where("false"), F.lit(True)).count() == 0


def test_blocks_do_not_change_what_is_found(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector with a third of all rows
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    monkeypatch.setattr(neighbours, "HELD", 50)
    found: dict = {}
    for r in neighbours.search(frame, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute(dict(rows), list(found), 10)
    hits = [len(found[q] & {i for i, _ in expected[q]}) / 10 for q in found]
    assert len(found) == 30 and np.mean(hits) >= 0.9


def test_most_rows_are_neither_ranked_nor_compared():
    """Recall against brute force, and the share of rows that queries touch, on blocks of 20,000 rows."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 32)) + 1.5 * rng.normal(size=(60, 32))[rng.integers(60, size=20_000)]
    points = x[rng.choice(20_000, neighbours.PIVOTS, replace=False)]
    near = neighbours.orders(x, points, neighbours.PREFIX)
    files = [
        neighbours.Files(neighbours.Rows(np.arange(a, a + 5000), x[a : a + 5000], near[a : a + 5000]), neighbours.POSTS)
        for a in range(0, 20_000, 5000)
    ]
    hits, ranked, compared = [], 0, 0
    for q in range(0, 20_000, 500):
        places = neighbours.places_of(near[q : q + 1], len(points))[0]
        parts = []
        for own in files:
            ids, score, met, kept = own.nearest(q, x[q], near[q], places, 10, neighbours.PROBES, neighbours.SHARE)
            parts.append((np.full(len(ids), q), ids, score))
            ranked, compared = ranked + met, compared + kept
        found = neighbours._best(parts, 10)[1]
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        hits.append(len(np.intersect1d(found, np.argsort(far)[:10])) / 10)
    assert np.mean(hits) >= 0.9
    assert ranked <= 0.3 * 40 * 20_000 and compared <= 0.16 * 40 * 20_000


@needs_tables
def test_recall_on_the_given_vectors(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    found: dict = {}
    for r in QUERIES["op1_permutation_neighbours"](spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute(rows, list(found), 10)
    assert sorted(found) == [i for i in sorted(rows) if i % 100 == 0]
    assert np.mean([len(found[q] & {i for i, _ in expected[q]}) / 10 for q in found]) >= 0.9


# ---- pages ---------------------------------------------------------------------------------


def article_of(source):
    """The article of the given pages by their markup."""
    inside = re.search("<article>(.*)</article>", source, re.S)[1]
    parts = re.split("</?(?:p|h1)>", inside)
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts)
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def pages(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def trees(pages):
    return H.fit(pages[:120])


def test_pages_give_their_article(pages, trees):
    assert H.extract(pages, trees) == [article_of(p) for p in pages]


def test_other_markup_and_furniture(pages, trees):
    rng = np.random.default_rng(5)
    text = sorted({w for p in pages[100:130] for w in re.sub("<[^>]*>", " ", p).split() if "&" not in w})
    good = 0
    for source in pages[130:230]:
        made = H._variant(source, rng, text)
        page, inside = H._labelled(made)
        expected = H.text_of(page, [H.IN if x else H.OUT for x in inside])
        good += H.extract([re.sub(f" (data-main|{H._MARK})", "", made)], trees) == [expected]
    assert good >= 93


def test_no_kept_element_lies_under_a_cut_one(pages, trees):
    rng = np.random.default_rng(1)
    for source in pages[:40]:
        page = H.read(source)
        states = H.decode(page, rng.random(len(page.tags)))
        for i, p in enumerate(page.parents):
            if p >= 0:
                assert not (states[p] == H.CUT and states[i] != H.CUT)
                assert not (states[p] == H.IN and states[i] == H.OUT)


def test_odd_pages(spark, trees):
    odd = [None, "", "<", "plain", "<p>a", "<article><p>x &amp; y&am", "<div>" * 3000, "<b>" * 4000 + "x", "<p>" + "word " * 30_000, "<script>if (a<b) x()", "<!-- <p>x", "\x00<p\x00>"]
    frame = spark.createDataFrame([(i, "u", h, 1) for i, h in enumerate(odd)], "page_id long, url string, html string, text int")
    rows = H.main_text(frame, trees, also=("url",)).collect()
    assert len(rows) == len(odd) and all(r.n_chars == len(r.text) for r in rows)
    assert H.main_text(frame.where("false"), trees).count() == 0
    assert H.extract(["<p>x</p>"], H.fit([])) == [""]
    assert H.sample(frame.where("false")) == []
    with pytest.raises(ValueError, match="no page marks"):
        H.sample(frame.where("page_id = 4"))


def test_markup_is_read_as_browsers_do():
    words = lambda page: " ".join(x for i, _, x in page.pieces if i >= 0 and page.tags[i] not in H._NEVER).split()
    assert words(H.read('<p title="5" wide">one two</p><p a=\'x>y\'>three</p><p b="z>four</p><p>five')) == "one two three four five".split()
    for tag in ("select", "svg"):
        assert words(H.read(f"<p>one</p><{tag}><option>x<p>two</p><div>three</div>")) in (["one", "two", "three"], ["one", "x", "two", "three"])
    assert words(H.read("<object><p>one</p></object><template><p>two</p></template>")) == ["one", "two"]
    page = H.read("one<br>two <b>three</b>")
    assert page.tags == ["body", "br", "b"] and words(page) == ["one", "two", "three"]
    assert H.read("<!DOCTYPE html>\n<html><body>x</body></html>\n").tags == ["html", "body"]


def test_words_are_learned_from_other_pages(pages):
    """A word in no list: pages that show it outside their article teach that it is furniture."""
    blurb = "Some words about the house that come with every page, long enough to look like a paragraph of text."
    shown = [p.replace("</article>", f'</article><div class="zork-{i}"><p>{blurb}</p></div>') for i, p in enumerate(pages[:60])]
    model = H.fit(shown)
    assert model.lean[H._bucket("zork")] < -2 and not H._buckets(["17", ""])
    unseen = [p.replace("</article>", f'</article><div class="zork"><p>{w}. {blurb[:60]}</p></div>')
              for p, w in zip(pages[200:300], "abcdefghij" * 10)]
    assert H.extract(unseen, model) == [article_of(p) for p in pages[200:300]]
    hidden = [p.replace("<article>", "<div>").replace("</article>", "</div>") for p in unseen]
    assert sum("come with" in t or blurb[:40] in t for t in H.extract(hidden, model)) <= 3


def test_a_fold_does_not_see_its_own_words():
    page = H.read('<div class="only here"><p class="here 12">x</p></div>')
    seen = H.shown([(page, np.array([0.0, 1.0]))])
    assert seen.sum() == 3 and list(seen[H._bucket("here")]) == [1, 1] and list(seen[H._bucket("only")]) == [0, 1]
    lean = H.leaning(seen)
    assert lean[H._bucket("here")] == 0 and lean[H._bucket("only")] < 0 and not H.leaning(seen - seen).any()
    told = H.features(page, lean)[:, -6:]  # own, parent's and ancestors' least and most
    assert told[0, 0] < 0 and told[1, 2] == told[0, 0] and told[1, 4] == told[0, 0] and not told[1, :2].any()


def test_furniture_of_a_page_is_rendered():
    source = '<body><nav class="top"><a>x &lt; y</a></nav><article><p>in</p><div>in too</div></article><div>after<br><b>z</b></div><p> </p></body>'
    assert H.furniture(*H._labelled(source)) == [
        f'<nav {H._MARK} class="top"><a>x &lt; y</a></nav>', f"<div {H._MARK}>after <br><b>z</b></div>"]


def test_link_lists_under_any_word_are_cut(trees):
    one = "The harbour was quiet when the first boats came back, and nobody spoke about the weather of the night before."
    two = "By noon the market had filled up; fish, salt and rope were sold from carts, and children ran between them."
    for word in ("teaser-list", "xq-7", "story__links", "mod"):
        links = "".join(f"<li><a href='/{x}'>{x} of the north</a></li>" for x in ("Boats", "Prices", "Weather"))
        page = f"<html><body><article><h1>Harbour</h1><p>{one}</p><div class='{word}'><ul>{links}</ul></div><p>{two}</p></article></body></html>"
        assert H.extract([page], trees) == [f"Harbour\n{one}\n{two}"]


def test_hand_made_pages(trees):
    """Pages that no training code has made."""
    one = "The harbour was quiet when the first boats came back, and nobody spoke about the weather of the night before."
    two = "By noon the market had filled up; fish, salt and rope were sold from carts, and children ran between them."
    code = "for x in range(3):\n    print(x)"
    pages = {
        f"<html><body><nav><a href='/'>Home</a> <a href='/b'>Blog</a></nav><div class='post'><h1>Harbour</h1><p>{one}</p><pre>{code}</pre><p>{two}</p></div><footer>Copyright</footer></body></html>":
            f"Harbour\n{one}\nfor x in range(3): print(x)\n{two}",
        f"<main><p>{one}</p><p title=\"5\" wide\">{two}</p></main><div class='sidebar'><ul><li><a href='/a'>More</a></li><li><a href='/c'>Most</a></li></ul></div>": f"{one}\n{two}",
        f"{one}\n{two}": f"{one} {two}",
        f"{one}<br>{two}": f"{one} {two}",
    }
    assert H.extract(list(pages), trees) == list(pages.values())


# ---- pipeline and registry -----------------------------------------------------------------


@needs_tables
def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language ID" and len(corpus_pipeline.STAGES) == 5
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, written(stage(spark, docs, SF), "stage")
        counts.append(docs.count())
        if stage is not corpus_pipeline.pack_sequences:
            assert docs.columns == columns
            assert docs.join(given, "doc_id", "left_anti").count() == 0
        if stage is corpus_pipeline.drop_near_duplicates:
            left = jaccard.near_duplicates(docs, size=5, percent=80)
            assert left.where("component_id <> doc_id").count() == 0
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] >= counts[4]
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {r.doc_id for r in given.select("doc_id").collect()}


@needs_tables
def test_pipeline_passes_further_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).withColumn("score", F.lit(1)).withColumn("rate", F.lit("x"))
    for frame in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = written(stage(spark, frame, SF), "stage")
            assert frame.columns == docs.columns


def test_language_stage_without_labels_keeps_texts_with_letters(spark):
    frame = spark.createDataFrame([(1, "abc", None), (2, "12 !", None), (3, None, None), (4, "", "x")], "doc_id long, text string, lang string")
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, frame, "").collect()] == [1]


def test_broadcasts_end_with_their_stage(spark):
    with released():
        held = shared(spark, [1, 2])
        assert held.value == [1, 2]
    with pytest.raises(Exception):
        spark.range(2).rdd.map(lambda x: held.value).collect()


def test_every_query_is_registered():
    found = entry_module.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in found)] == []


@needs_tables
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for view in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS FROM '{SF}/{view}.parquet'")
    expected = con.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == sorted(expected.fetchall(), key=str)


def test_scratch_folders_are_below_the_shared_one(spark):
    assert folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
