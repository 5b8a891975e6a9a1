"""The corpus pipeline: quality rules, near copies, repeated passages, secrets, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that its predecessor
kept. ``run`` writes each stage's result to the shared scratch folder and rereads
it, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, packing, quality, secretscan, suffixes
from tidemark.llm.vocabularies import BYTE_BPE, BYTE_BPE_ADDED
from tidemark.session import scratch_path
from tidemark.sources.tables import scan


def resized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by id, of each group that links at 80 % of its five-word shingles."""
    return jaccard.one_per_group(docs, k=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings of 200 that also start elsewhere; emptied ones stay, empty."""
    return resized(suffixes.removed(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by the name of its kind."""
    return resized(secretscan.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens."""
    return packing.packed(docs, *BYTE_BPE, added=BYTE_BPE_ADDED)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packing_stage),
]

# Tokens, byte strings and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
