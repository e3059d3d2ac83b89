"""Documents to packed sequences: the stages, in order, and the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import decontamination, jaccard_join, language, line_dedup, packing
from corvane.llm.common import small_batches, stored, table, unused

LEAST_SCORE = 0.5
"""Posterior of the best language below which a document is rejected."""
LEAST_FIT = -3.0
"""Mean log probability of an n-gram, against that of the language's own, below which a document is rejected."""


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, without a language more likely than the others together, or whose n-grams
    are far from those of their language, go."""
    small_batches(spark)
    model = language.train(docs.filter(~language.held_out()))
    lang, score, fit = (unused(docs, c) for c in ("_lang", "_lang_score", "_lang_fit"))
    named = language.identify(docs, model, pred_col=lang, score_col=score, fit_col=fit)
    kept = (F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE) & (F.col(fit) >= LEAST_FIT)
    return named.filter(kept).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur across documents stay in the last of them only; n_chars counts what is left."""
    left = line_dedup.drop_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones stays."""
    return jaccard_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.decontaminate(docs, decontamination.items_of(table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language id", language_id),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

ORACLE_SQL = None
"""Naive Bayes, the similarity join and byte-pair ids have no SQL; tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
