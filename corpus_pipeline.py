"""Documents to packed training sequences: language, quality, near duplicates, packing.

Every stage takes all rows that its predecessor kept. ``run`` writes each stage's result
to the shared folder and reads it again. SQL cannot express these stages, so
``ORACLE_SQL`` is None; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import language, packing, quality_trees, simhash
from eventmart.llm.queries import language_model, quality_model
from eventmart.llm.runtime import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose language is a guess."""
    predict = language.predictor(docs, language_model(docs))
    return docs.where(language.trusted(predict(F.col("text"))))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents the classifier takes for poor."""
    score = quality_trees.scorer(docs, quality_model(docs, sf_dir))
    return docs.where(score(F.col("text")) >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near duplicates.

    Near duplicates are those of ``op2_simhash``: SimHash over four-word shingles, at most 4
    of 64 bits apart. That is stricter than a shingle similarity of 0.8: most such pairs
    are further apart and both stay (README).
    """
    return simhash.deduplicate(docs, "doc_id", "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the training sequences."""
    return packing.pack(docs, "doc_id", "text")


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
