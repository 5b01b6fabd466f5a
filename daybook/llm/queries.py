"""The registered queries of this subpackage: thin calls of its operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    centroids,
    html_text,
    infill,
    jaccard,
    language,
    licenses,
    lines,
    mixing,
    neighbours,
    packing,
    secrets,
    sharding,
    sketches,
)
from daybook.llm.scratch import reach, written


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_permutation_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


#: Shares of expected tokens that the mixture should have.
MIXTURE = {"clean": 0.94, "low": 0.05, "toxic": 0.01}


def label_domain():
    """The domain that a row of `labels` tells."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(
        F.col("quality") == 1, "clean"
    )


def op2_soft_mixing(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    model = mixing.fit(mixing.sample(documents, _table(spark, sf, "labels"), label_domain()))
    table = written(mixing.memberships(documents, model), "memberships")
    fit = mixing.fit_steps(table, model.domains, MIXTURE)
    shares = [
        F.element_at("posterior", i + 1).alias(f"p_{domain}") for i, domain in enumerate(model.domains)
    ]
    rated = mixing.rated(table, fit.steps, model.domains)
    return rated.select("doc_id", "tokens", *shares, "rate", F.lit(fit.residual).alias("residual"))


def op3_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.edited_fingerprints(_table(spark, sf, "documents"))


def word_tokenizer() -> str:
    """Where the installed vocabulary of op4 lies; the same on every machine of a cluster."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), word_tokenizer())


def op5_crf_language(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    held_out = F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)
    )
    model = language.fit(language.sample(documents, ~held_out))
    return language.identify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(
        _table(spark, sf, "documents"), size=4, percent=85, fold_case=True
    )


def op7_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    model = html_text.fit(html_text.sample(pages))
    return html_text.main_text(pages, model, also=("url",))


def op8_hilbert_shards(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shards(
        _table(spark, sf, "documents"), ["lang", "source", "n_chars", "doc_id"]
    )
    return placed.withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.repeated_lines(_table(spark, sf, "documents")).drop("row")


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(_table(spark, sf, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = infill.transform(_table(spark, sf, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(infill.restored(), 256)}
    return made.withColumns(digests).drop("output")


def op12_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.summary(licenses.scan(_table(spark, sf, "documents")))


def op13_ns_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf, "embeddings")).drop("evaluations")


QUERIES = {
    "op1_permutation_neighbours": op1_permutation_neighbours,
    "op2_soft_mixing": op2_soft_mixing,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_crf_language": op5_crf_language,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_html_main_text": op7_html_main_text,
    "op8_hilbert_shards": op8_hilbert_shards,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_license_scan": op12_license_scan,
    "op13_ns_centroids": op13_ns_centroids,
}

# Two lines are one edit apart if they agree without the character at one place, or if the longer one
# without a character is the shorter.
OP9_SQL = r"""
WITH every AS (
  SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
), lines AS (
  SELECT *, length(trim(line, concat(' ', chr(9), chr(11), chr(12), chr(13)))) AS trimmed FROM every
), fit AS (
  SELECT * FROM lines WHERE trimmed >= 1
), one AS (
  SELECT line, min((doc_id, line_no)) AS place, min(trimmed) AS trimmed FROM fit GROUP BY line
), shorter AS (
  SELECT line, place, i, hash(substr(line, 1, i - 1) || substr(line, i + 1)) AS rest, length(line) AS n
  FROM (SELECT line, place, unnest(range(1, length(line) + 1)) AS i FROM one WHERE trimmed >= 20)
), pairs AS (
  SELECT a.place AS p, b.place AS q FROM shorter a JOIN shorter b
    ON a.n = b.n AND a.i = b.i AND a.rest = b.rest AND a.line <> b.line
  UNION
  SELECT a.place, b.place FROM shorter a JOIN one b ON a.rest = hash(b.line) AND a.n = length(b.line) + 1
    WHERE b.trimmed >= 20
), sides AS (
  SELECT p, q FROM pairs UNION SELECT q, p FROM pairs
), near AS (
  SELECT q AS place, min(p) AS earlier FROM sides WHERE p < q GROUP BY q
)
SELECT f.doc_id, CAST(f.line_no AS INTEGER) AS line_no, CAST(length(f.line) AS INTEGER) AS n_chars,
       coalesce(earlier, o.place)[1] AS first_doc_id,
       CAST(coalesce(earlier, o.place)[2] AS INTEGER) AS first_line_no,
       CAST(earlier IS NOT NULL AS INTEGER) AS edits
FROM fit f JOIN one o USING (line) LEFT JOIN near USING (place)
WHERE (f.doc_id, f.line_no) <> coalesce(earlier, o.place)
"""

OP6_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM split
), each AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, y FROM reach r JOIN links ON other = x
)
SELECT doc_id, len(s) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x) USING (doc_id)
"""

OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents
), drawn AS (
  SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, array_to_string(w[1 : least(a, b)], '') AS p,
         array_to_string(w[least(a, b) + 1 : greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1 :], '') AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


def _op12_sql() -> str:
    """The license scan by plain comparison of every block with every template."""
    words = [licenses.words_of(text) for _, text in licenses.TEMPLATES]
    templates = ", ".join(
        f"('{label}', {licenses.block_step(len(w))}, {sorted(set(w))})"
        for (label, _), w in zip(licenses.TEMPLATES, words)
    )
    phrases = ", ".join(f"({licenses.words_of(phrase)}, '{label}')" for phrase, label in licenses.PHRASES)
    return rf"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), phrases AS (
  SELECT * FROM (VALUES {phrases}) AS p(phrase, label)
), templates AS (
  SELECT * FROM (VALUES {templates}) AS t(label, step, words)
), starts AS (
  SELECT r, w, unnest(range(len(w))) AS i FROM split
), base AS (
  SELECT r, i, label FROM starts, phrases WHERE w[i + 1] = phrase[1] AND w[i + 1 : i + len(phrase)] = phrase
), firsts AS (
  SELECT r, w, step, unnest(range(greatest(1, CAST(ceil(len(w) / step) AS BIGINT) - 1))) * step AS i
  FROM split, (SELECT DISTINCT step FROM templates)
), blocks AS (
  SELECT r, step, list_distinct(w[i + 1 : i + 2 * step]) AS b FROM firsts
), shares AS (
  SELECT r, label, len(list_intersect(b, words)) AS own, len(words) AS n FROM blocks JOIN templates USING (step)
), held AS (
  SELECT r, label, own / n AS share FROM shares WHERE 100 * own >= {licenses.PERCENT} * n
), places AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r
), every AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM held UNION ALL SELECT r, label, 1.0 FROM base) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM split LEFT JOIN places USING (r) LEFT JOIN every USING (r)
"""


def _op13_sql(k: int = 8, rounds: int = 10, width: int = 64) -> str:
    """Plain Lloyd: every round compares every vector with every centroid."""
    square = "CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, min((d, j))[2] AS j, min(d) AS d FROM (SELECT r, j, {square} AS d FROM v, c{t}) GROUP BY r
)""")
        if t < rounds:
            steps.append(f"""
s{t} AS (
  SELECT j, i, sum(x) AS s, count(*) AS n
  FROM (SELECT j, unnest(v) AS x, unnest(range({width})) AS i FROM a{t} JOIN v USING (r)) GROUP BY j, i
), c{t + 1} AS MATERIALIZED (
  SELECT j, coalesce(m, c) AS c FROM c{t} LEFT JOIN (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{t} GROUP BY j
  ) USING (j)
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {width}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS j, v AS c
  FROM (SELECT sha256('3:' || vec_id) AS h, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})
), {",".join(steps)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (j)
"""


ORACLES: dict[str, str] = {
    "op6_ngram_jaccard_join": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_license_scan": _op12_sql(),
    "op13_ns_centroids": _op13_sql(),
}
