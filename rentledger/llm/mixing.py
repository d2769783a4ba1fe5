"""Mix sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source, documents are ordered by that key, which is cut into ranges by its
leading digits: sizes are summed up within each range, and the sums of ranges give each its offset, so no task
holds a source, unless it is one document repeated. A source is taken whole as often as its target allows, and once more up to the cut where the running
sum comes nearest to what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered, row_number

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
# Leading hexadecimal digits of the key that name a range: 16 ** 3 ranges for each source.
RANGE_DIGITS = 3
WORDS = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, seed: str = SEED, number: str | None = None) -> DataFrame:
    """``doc_id, row_no, source, size, key``; the size is the number of words, 0 for a null text."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long")
    # The text is part of it, so that documents that repeat an id are spread as well.
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    return docs.select("doc_id", row_number(number), "source", size.alias("size"), key.alias("key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` of each source.

    Sources by code point, null last, get the weights in turn. In the order of size per weight, sources that the even level would fill
    beyond ``repeats`` times their size get just that; the others share what is left by weight. These windows hold one
    row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = sums.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    line = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(0, Window.unboundedFollowing)
    whole = F.sum("source_size").over(Window.partitionBy())
    left = whole * F.lit(float(share)) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(repeats)
    even = left * F.col("weight") / F.sum("weight").over(after)
    filled = ranked.withColumn("even", even).withColumn("cap", F.col("source_size") * F.lit(repeats))
    # Once a source stays under its cap, so do all with a higher ratio, and the level of the first holds for them.
    level = F.min(F.when(F.col("even") <= F.col("cap"), F.struct("ratio", F.col("source").isNull(), "source", (F.col("even") / F.col("weight")).alias("level"))))
    filled = filled.withColumn("level", level.over(line.rowsBetween(Window.unboundedPreceding, 0))["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, scratch: Scratch, digits: int = RANGE_DIGITS, number: str | None = None, **rules) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, row_no``.

    ``taken`` is 0, 1 or 2 times the size (with the default rules). Repeated rows are separate documents; ties of the key are
    ordered by doc_id and size. An empty table gives no rows. Other columns are ignored.
    """
    sizes = scratch.save(measured(docs, rules.pop("seed", SEED), number), "sizes")
    range_ = F.substring("key", 1, digits)
    rows = sizes.withColumn("range", range_)
    goals = targets(sizes, **rules)
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    line = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("range_size").over(line), F.lit(0).cast("long")))
    sums = sums.join(goals.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    sums = scratch.save(sums.select(F.col("source").alias("_source"), F.col("range").alias("_range"), "offset", "source_size", "target"), "ranges")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "row_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))
    rows = rows.join(sums, on)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    rest = F.col("target") - epochs * F.col("source_size")
    once_more = (F.col("offset") + F.col("inside")) * 2 + F.col("size") <= rest * 2
    taken = F.col("size") * (epochs + F.when(once_more, 1).otherwise(0))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "row_no")


def apply_mix(docs: DataFrame, scratch: Scratch, **rules) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Documents without words are kept once: they cost nothing."""
    rows, number = numbered(docs, scratch)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("int")
    taken = mix(rows, scratch, number=number, **rules).select(F.col("row_no").alias(number), times.alias(f"{number}_times")).where(f"{number}_times > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{number}_times"))).alias(f"{number}_copy")
    return rows.join(taken, number).select(*docs.columns, copies).drop(f"{number}_copy")


def _sql() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return rf"""
WITH d AS (
  SELECT doc_id, source, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} {weights} END AS weight
      FROM d GROUP BY source),
f AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {REPEATS}) * weight
             / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS even
      FROM s WINDOW w AS (ORDER BY source_size / weight, source ASC NULLS LAST)),
l AS (SELECT arg_min(even / weight, (source_size / weight, source)) AS level, min(source_size / weight) AS ratio
      FROM f WHERE even <= source_size * {REPEATS}),
t AS (SELECT f.source, source_size, CASE WHEN l.level IS NULL OR source_size / weight < l.ratio
             THEN (source_size * {REPEATS})::DOUBLE ELSE l.level * weight END AS target FROM f, l),
r AS (SELECT d.*, t.source_size, t.target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN before * 2 + size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


SQL = _sql()
