"""Cleaning of a document corpus: quality, exact copies, near copies, leaked test items, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opslake.llm import bm25, bpe, cuckoo, line_crf, simhash
from opslake.llm.queries import quality_model, rank_file
from opslake.sources.scratch import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose score by the CRF over lines is below 0.3."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return line_crf.keep_good(docs, quality_model(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return cuckoo.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item."""
    return bm25.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    return bpe.encode(docs, *rank_file())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

# SimHash, the classifier and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written and read again."""
    folder = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
