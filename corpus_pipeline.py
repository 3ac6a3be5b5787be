"""Corpus pipeline: toxicity, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on everything that its predecessor kept, and is written as Parquet
before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontam, packing, secretscan, simhash, toxicity
from barloom.llm.scratch import Scratch


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of those that are not held out."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies by SimHash the document with the least id stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; every document stays."""
    return secretscan.redact(docs, secretscan.fit())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the trained stages; tests/llm hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
        if last is not None:
            scratch.drop(last)
        last = docs
    return docs
