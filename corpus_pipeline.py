"""The corpus pipeline: toxic documents go, copies go, near copies go, sources are mixed, the rest is packed.

Every stage reads what the one before it wrote and takes ``(spark, docs, sf_dir)``. All but the last return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentledger.llm import chunks, mixing, packing, simhash, toxicity
from rentledger.llm.common import Scratch


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, labels, Scratch(spark, "pipe-toxicity"))


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunks.keep_one(docs, Scratch(spark, "pipe-exact"))


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, Scratch(spark, "pipe-near"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, Scratch(spark, "pipe-mix"))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs), Scratch(spark, "pipe-pack"))


STAGES = [
    ("toxicity", _toxicity),
    ("exact_dedup", _exact),
    ("simhash_near_dedup", _near),
    ("source_mixing", _mix),
    ("best_fit_packing", _pack),
]

# The classifier and the fingerprint groups can't be said in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
