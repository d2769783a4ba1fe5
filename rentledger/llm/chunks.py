"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its own content says so: at the first boundary pattern behind a least length, or at a
greatest length if there is none. A chunk is identified by its SHA-256, and the identifiers are verified: all distinct
chunks are gathered once, deduplicated where they are read and again behind the shuffle, and an identifier that
stands for two different chunks stops the run. From then on a document is the ordered list of its chunk identifiers. Only
these lists move; documents are equal exactly when their lists are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, row_number

# Characters of a chunk: least, greatest; and what may end one.
LEAST, GREATEST = 1024, 8192
BOUNDARY = r"[.!?,;:\s][\s\p{Lu}]"


def cut(text: Column, least: int = LEAST, greatest: int = GREATEST, boundary: str = BOUNDARY) -> Column:
    """The chunks of a text in order; joined they are the text. An empty text has none."""
    pattern = rf"(?s)(?:.{{{least},{greatest}}}?(?={boundary})|.{{1,{greatest}}})"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, number: str | None = None, **cuts) -> DataFrame:
    """``doc_id, row_no, recipe, text_sha256``; ``row_no`` tells rows with the same doc_id apart.

    ``number`` names a column that numbers the rows; without it they are made in this pass.
    """
    text = F.coalesce("text", F.lit(""))
    ids = F.transform(cut(F.col("text"), **cuts), lambda c: F.unhex(F.sha2(c.cast("binary"), 256)))
    rows = docs.select("doc_id", row_number(number), text.alias("text"))
    return rows.select("doc_id", "row_no", ids.alias("recipe"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def chunk_ids(docs: DataFrame, **cuts) -> DataFrame:
    """``chunk_id, texts``: every chunk identifier and the number of distinct chunks that have it."""
    chunks = docs.select(F.explode(cut(F.col("text"), **cuts)).alias("chunk"))
    chunks = chunks.select(F.unhex(F.sha2(F.col("chunk").cast("binary"), 256)).alias("chunk_id"), "chunk").distinct()
    return chunks.groupBy("chunk_id").agg(F.count("*").alias("texts"))


def exact_groups(docs: DataFrame, scratch: Scratch, number: str | None = None, **cuts) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, row_no``.

    The largest doc_id of equal texts stays; null texts count as empty, and empty texts are equal. Of rows that repeat the
    largest doc_id, one stays. A null doc_id stays only if its group has no other; keep_id is null then. Other
    columns are ignored.
    """
    clash = chunk_ids(docs.select("text"), **cuts).where("texts > 1").limit(1).count()
    if clash:
        raise ValueError("two different chunks share a SHA-256; identifiers can't be used")
    # Written once, so that both sides of the join below are plain shuffles, which Spark can split at a hot recipe.
    lists = scratch.save(recipes(docs, number, **cuts), "recipes")
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row_no")
    groups = lists.groupBy("recipe").agg(F.max(order).alias("keep"), F.count("*").alias("group_size"))
    groups = scratch.save(groups, "groups")
    joined = lists.join(groups, "recipe")
    kept = F.col("row_no") == F.col("keep.row_no")
    return joined.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "row_no")


def keep_one(docs: DataFrame, scratch: Scratch, **cuts) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    rows, number = numbered(docs, scratch)
    stays = exact_groups(rows, scratch, number, **cuts).where("kept").select(F.col("row_no").alias(number))
    return rows.join(stays, number, "left_semi").drop(number)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
