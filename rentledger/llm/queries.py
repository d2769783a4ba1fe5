"""One query per operator over its whole table, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chunks, collocations, divergence, html, mixing, packing, sharding, simhash, tokenbin, tokencount, topk, toxicity, warc
from .common import Scratch


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    archives = warc.write_archives(_table(spark, folder, "pages"), scratch)
    return warc.read_records(archives, scratch).drop("payload")


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return packing.pack(packing.pieces(docs), Scratch(spark, "packing"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, folder, "documents"), Scratch(spark, "simhash"))
    return groups.select("doc_id", simhash.hex_digits(groups["fp"]).alias("fingerprint"), "component_id")


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.exact_groups(_table(spark, folder, "documents"), Scratch(spark, "chunks")).drop("row_no")


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), Scratch(spark, "mixing")).drop("row_no")


def op7_hash_tree_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(_table(spark, folder, "documents"), Scratch(spark, "sharding"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return toxicity.classify(docs, labels, Scratch(spark, "toxicity")).drop("row_no")


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(_table(spark, folder, "embeddings"), Scratch(spark, "topk"))


def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "ids")
    manifest = tokenbin.write_ids(_table(spark, folder, "documents"), scratch)
    return tokenbin.read_ids(manifest, scratch)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), Scratch(spark, "phrases"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(_table(spark, folder, "documents"), Scratch(spark, "divergence"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash": op3_simhash,
    "op4_main_text": op4_main_text,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_hash_tree_sharding": op7_hash_tree_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_topk": op9_topk,
    "op10_token_ids": op10_token_ids,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {
    "op5_exact_dedup": chunks.SQL,
    "op6_source_mixing": mixing.SQL,
    "op9_topk": topk.SQL,
    "op11_collocations": collocations.SQL,
    "op13_source_divergence": divergence.SQL,
}
