"""The corpus pipeline: filter, deduplicate, clean and pack the documents table.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; all but the last return the columns of ``documents``. What a
stage returns is written as Parquet in the shared folder and read again, so a
lost executor costs the tasks that ran on it and no earlier stage.

Rows with null text count as empty; documents that become empty stay (an empty
text packs into its end token). An empty table passes through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm import near_dedup, packing, quality, secret_scan, suffix_dedup
from trendspark.llm.common import saved, table

#: Bytes of a repeated passage: about 40 words of mean length. A passage of 50 words is found unless its words are so short that it has fewer bytes.
PASSAGE_BYTES = 200


#: What a task hands to Python at once: workers and executors hold a few such batches, however long the texts are.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def _bounded(spark: SparkSession) -> None:
    """Small Arrow batches for the stages of this session."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` brought up to date with the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network takes for label 1; it learns from the labels of those at hand."""
    _bounded(spark)
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at 0.8 on five-word shingles."""
    _bounded(spark)
    return near_dedup.one_of_each(docs, percent=80, width=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur at more than one place."""
    _bounded(spark)
    return _counted(suffix_dedup.remove_repeats(docs, PASSAGE_BYTES))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in the place of each secret."""
    _bounded(spark)
    return _counted(secret_scan.redact_secrets(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    _bounded(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_filter),
    ("near duplicates", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scan", secrets),
    ("best-fit packing", packed),
]

#: The stages learn models and iterate; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
