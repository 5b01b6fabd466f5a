"""A training-corpus pipeline over `documents`: each stage calls one operator of `daybook.llm`.

Stages take (spark, docs, sf_dir) and return what they keep; all but the last return the columns of
documents. Each one works on every row that its predecessor kept, and `run` writes and rereads every result,
so a lost executor costs at most the stage at hand.

Null and empty texts are rejected by the first stage, as they have no language; without any label of a
language it keeps all texts that have a letter; rows with a null id stay, but link with nothing; rows that repeat are lines and documents like any other; an empty table
passes through; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import jaccard, language, lines, mixing, packing
from daybook.llm.queries import MIXTURE, label_domain, word_tokenizer
from daybook.llm.scratch import reach, released, written

#: A text is rejected if no language has this share of its letters.
LEAST_LANGUAGE_SHARE = 0.4
#: Documents of at least this rate stay for sure; the others are drawn by their rate.
SURE_RATE = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are in some language.

    Without a labelled text no language is known, and documents that have a letter stay.
    """
    reach(spark)
    model = language.fit(language.sample(docs, F.lit(True)))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.accepted(docs, model, LEAST_LANGUAGE_SHARE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines, equal ones however short, out of all documents but the earliest; n_chars follows."""
    kept = lines.without_lines(docs, lines.repeated_lines(docs))
    if "n_chars" in kept.columns:
        kind = kept.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.length("text").cast(kind))
    return kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of documents that links of similarity 0.8 hold together."""
    found = jaccard.near_duplicates(docs, size=5, percent=80)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that the domains' expected tokens meet the target weights.

    Clean documents are not given up for that: of a corpus cleaner than the targets everything stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mixing.fit(mixing.sample(docs, labels, label_domain()))
    table = written(mixing.memberships(docs, model, rows=True), "memberships")
    fit = mixing.fit_steps(table, model.domains, MIXTURE, whole="clean")
    return mixing.drawn(table, fit.steps, model.domains, SURE_RATE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into training sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix_to_targets),
    ("best-fit packing", pack_sequences),
]

#: Trained models and tokenizers have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, every stage's result written and read again."""
    reach(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with released():
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
