"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import fuzzy_lines, minhash, packing, quality, rules
from pulsegrid.llm.common import table, written

#: Some stages fit a model or iterate, which SQL cannot say; tests hold each stage against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3, learned from labels that are not held out."""
    model = quality.fit_quality(docs, quality.learnable(table(spark, sf_dir, "labels", "doc_id", "quality")))
    scored = quality.score_quality(docs, model, into="__score")
    return scored.where("__score >= 0.3").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return rules.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-equal lines stays; documents of which no line stays go, n_chars follows the text."""
    cleaned = fuzzy_lines.dedup_lines(docs, empty=False)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.selectExpr(*(f"cast(coalesce(length(text), 0) as {t}) as n_chars" if c == "n_chars" else f"`{c}`" for c, t in docs.dtypes))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`; each result is a table in the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
