"""The corpus pipeline: quality, near-duplicates, repeated passages, leaked benchmark items, tokens.

Each stage gets what its predecessor kept as ``docs`` (the columns of documents) and returns a
DataFrame that is written as Parquet and read again for the next. The pipeline itself can't be expressed
in SQL (a learned classifier, hashing, tokenizing), so ORACLE_SQL is None; tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import common, decontam, minhash, quality, queries, spans

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.drop_poor(docs, queries._quality_labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return minhash.drop_near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages leave the texts; n_chars follows."""
    stripped = spans.remove_repeated_spans(docs).drop("removed_chars")
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return stripped.withColumn("n_chars", n_chars).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.drop_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return queries._token_digests(queries._encoded(spark, docs))


STAGES = [("quality", keep_quality), ("near duplicates", drop_near_duplicates), ("repeated passages", drop_repeated_passages), ("decontamination", drop_leaks), ("tokens", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        common.release(before)  # of the tables that stages were given, only the last is still read
    return docs
