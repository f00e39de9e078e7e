"""A cleaning pipeline over ``documents``: quality, language, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and reads
it again as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keelson.llm import jaccard, language, packing, quality
from keelson.session import stored

#: SQL cannot express these stages; they are tested against brute-force versions
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling against the documents labelled good."""
    return quality.keep_selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; null texts, texts without a letter and undecided ones go."""
    return language.keep_identified(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of at least 0.8 over five-word shingles."""
    return jaccard.keep_one_of_each(docs, words=5, numerator=4, denominator=5)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
