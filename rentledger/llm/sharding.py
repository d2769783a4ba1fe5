"""Sharding by a hierarchical weighted hash tree.

A document descends from regions to racks to shards. At each level every child draws a number from the hash of document and
child, ``-ln(u) / weight``, and the smallest draw wins, so a child gets documents in proportion to the weight below
it. A draw doesn't depend on the other children: when weights change below one child, documents move only into or out of
that child, and choices elsewhere stay. A new shard in a region of its own therefore takes documents only into itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SHARDS = 16
RACKS_PER_REGION, SHARDS_PER_RACK = 2, 2
SEED = "shard-1"
# Ranges of the document hash within which slots are numbered.
SLOT_DIGITS = 3
_UNIT = 16**12


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int = SHARDS) -> list[Shard]:
    """``shards`` equal shards in racks of two and regions of two racks."""
    per_region = RACKS_PER_REGION * SHARDS_PER_RACK
    return [Shard(s // per_region, s // SHARDS_PER_RACK, s) for s in range(shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a rack and region of its own."""
    return [*tree, Shard(max(s.region for s in tree) + 1, max(s.rack for s in tree) + 1, max(s.shard for s in tree) + 1, weight)]


def _draw(key: Column, node: str, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(f"{SEED}:{node}:"), key).cast("binary")), 1, 12)
    unit = (F.conv(digits, 16, 10).cast("double") + 1) / float(_UNIT + 1)
    return -F.log(unit) / F.lit(float(weight))


def _choose(key: Column, level: str, weights: dict[int, float], inner) -> Column:
    """The choice below the child with the smallest draw; of equal draws, the smaller number wins."""
    if len(weights) == 1:
        return inner(next(iter(weights)))
    draws = [F.struct(_draw(key, f"{level}{n}", w).alias("draw"), F.lit(n).alias("n")) for n, w in sorted(weights.items())]
    best = F.array_min(F.array(*draws))["n"]
    first, *rest = sorted(weights)
    choice = F.when(best == first, inner(first))
    for n in rest:
        choice = choice.when(best == n, inner(n))
    return choice


def place(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key, by descent through regions, racks and shards with positive weight."""

    def weights(level: int, rows: list[Shard]) -> dict[int, float]:
        sums: dict[int, float] = {}
        for s in rows:
            if s.weight > 0:
                sums[s[level]] = sums.get(s[level], 0.0) + s.weight
        return sums

    def racks(region: int) -> Column:
        rows = [s for s in tree if s.region == region]
        return _choose(key, "rack", weights(1, rows), lambda rack: shards([s for s in rows if s.rack == rack]))

    def shards(rows: list[Shard]) -> Column:
        return _choose(key, "shard", weights(2, rows), lambda n: F.lit(n))

    return _choose(key, "region", weights(0, tree), racks)


def assign(docs: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The doc_id and the topology decide alone; documents with equal ids share a shard, a null id is a key like any other. Size: bytes of
    the text, none for null, plus 1. Slots count from 0 without gaps in every shard: ranges of the document hash are
    numbered apart and follow each other, so no task holds a shard, unless it is one document repeated. Other columns are ignored.
    """
    tree = topology(shards)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    data = F.coalesce("text", F.lit("")).cast("binary")
    # Ranges for the slots: documents that repeat an id with other texts are spread over them as well.
    hash_ = F.md5(F.concat(F.lit(SEED + ":"), key, F.lit(":"), F.md5(data)).cast("binary"))
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, tree).alias("shard"),
        place(key, grown(tree)).alias("grown_shard"),
        F.substring(hash_, 1, SLOT_DIGITS).alias("range"),
    )
    rows = scratch.save(rows, "placed")
    counts = rows.groupBy("shard", "range").count()
    line = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "range", F.coalesce(F.sum("count").over(line), F.lit(0).cast("long")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy("doc_id", "text_crc32", "size")) - 1
    placed = rows.withColumn("inside", inside).join(before, ["shard", "range"])
    slot = (F.col("before") + F.col("inside")).alias("slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", slot, "grown_shard")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> None:
    """Write the documents themselves, one folder per shard, several files each."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    docs.withColumn("shard", place(key, topology(shards))).write.partitionBy("shard").parquet(folder)
