"""A training corpus in four stages: quality filter, near-duplicate removal, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import mixing, neardup, packing, quality
from ledgerline.llm.common import Scratch, documents, importable


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the discriminant, fitted on the labelled training rows among them, predicts as good."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = quality.train_on_labelled(docs, labels, Scratch(spark, "pipeline-quality"))
    return docs.filter(quality.score_column(model) >= 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest id) of each group of five-word-shingle similarity 0.8 or more.

    Repeated rows of one id and text are one document, several texts of one id
    are documents of their own; rows without an id stay.
    """
    importable(spark)
    return neardup.first_documents(docs, percent=80, bands=24, band_rows=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their target weights."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences; copies of a document are packed each by itself."""
    importable(spark)
    return packing.pack_documents(docs)


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("mixing", mix_sources), ("packing", pack)]

# No SQL: the first stage fits a model, the last packs with state.  tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
