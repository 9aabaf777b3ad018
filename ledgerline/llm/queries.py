"""The registered queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    bpe, embeddings, fingerprints, lm, mixing, neardup, oracle, packing, quality, repair, resample, sharding,
    tokenfiles,
)
from ledgerline.llm.common import documents, importable


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.wavelet_documents(documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.score_documents(documents(spark, sf_dir), labels)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.count_tokens(documents(spark, sf_dir))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_documents(documents(spark, sf_dir), percent=85)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(documents(spark, sf_dir), n_shards=24)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.withColumn("first_shard", F.get("shards", F.lit(0))).drop("shards")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return repair.audit(repair.damaged(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return resample.resample(documents(spark, sf_dir), benchmark)


def queries() -> dict:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {"op8_sharding": oracle.sharding(), "op9_mixing": oracle.mixing()}
