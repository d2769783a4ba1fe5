"""Exact top-k search by block-at-a-time pruning.

Vectors become integers; a component is a term, its value the term's weight. Vectors are ordered so that similar ones stand
together, and cut into blocks: ranges of that order with a forward index, a matrix of all components. For a query,
the sum over terms of the largest contribution in a block bounds every score in it. Each query takes the blocks
from the highest bound down, scores a whole block through its forward index, and stops as soon as the next bound is
below its k-th score. A bound equal to it is still scored, as ties go to the smaller id.

Shards of blocks and groups of queries meet in tiles of bounded size; the best of all tiles are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

K, EVERY, SCALE = 5, 50, 256
BLOCK, SHARD, QUERIES = 256, 16_384, 4_096
# Vectors whose nearest neighbours order the rest; a fixed bound.
LEADERS = 128
_LIMIT = 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, row_no, terms``: the floor of each scaled component, in double precision, as packed 64-bit integers.

    Vectors that are null or hold null or non-finite components, and rows without id, are left out. A value beyond 64 bits is an error.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            terms = []
            for x in batch.column(2):
                v = np.floor(np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64) * scale)
                if len(v) and np.abs(v).max() >= _LIMIT:
                    raise OverflowError("a component doesn't fit 64 bits")
                terms.append(v.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.binary())], names=["vec_id", "row_no", "terms"])

    embedding = F.col("embedding").cast("array<double>")
    rows = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row_no"), embedding)
    return rows.mapInArrow(run, "vec_id long, row_no long, terms binary")


def _matrix(terms: list[bytes], width: int):
    """Rows of equal width; what a shorter vector lacks is 0."""
    import numpy as np

    out = np.zeros((len(terms), width), np.int64)
    for k, t in enumerate(terms):
        v = np.frombuffer(t, "<i8")
        out[k, : len(v)] = v
    return out


def _product(a, b, bound: bool = False):
    """Exact integer products of the rows of two matrices; in doubles where no sum can pass 2 ** 53, in Python's integers where one may pass 2 ** 63.

    A score that a long can't hold is an error; as a ``bound`` it becomes the largest or smallest long.
    """
    import numpy as np

    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    if bound:
        return np.clip(wide, -_LIMIT, _LIMIT).astype(np.int64)
    if wide.size and max(wide.max(), -wide.min()) > _LIMIT:
        raise OverflowError("a score doesn't fit a long")
    return wide.astype(np.int64)


def forward_blocks(vectors: DataFrame, leaders: list[bytes], width: int, shards: int, block: int = BLOCK) -> DataFrame:
    """``shard, ids, rows, terms, top, bottom``: one row per block, similar vectors together."""

    def near(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        lead = _matrix(leaders, width)
        for batch in batches:
            score = _product(_matrix(batch.column(2).to_pylist(), width), lead, bound=True)
            leader = score.argmax(axis=1).astype(np.int32) if len(leaders) else np.zeros(batch.num_rows, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leader)], names=["vec_id", "row_no", "terms", "leader"])

    def cut(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        shard, ids, numbers, terms = TaskContext.get().partitionId(), [], [], []

        def made():
            part = _matrix(terms[:block], width)
            values = (np.array(ids[:block]), np.array(numbers[:block]), part, part.max(axis=0), part.min(axis=0))
            del ids[:block], numbers[:block], terms[:block]
            columns = [pa.array([shard], pa.int32()), *[pa.array([v.astype("<i8").tobytes()], pa.binary()) for v in values]]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "ids", "rows", "terms", "top", "bottom"])

        for batch in batches:
            ids += batch.column(0).to_pylist()
            numbers += batch.column(1).to_pylist()
            terms += batch.column(2).to_pylist()
            while len(ids) >= block:
                yield made()
        if ids:
            yield made()

    keyed = vectors.mapInArrow(near, "vec_id long, row_no long, terms binary, leader int")
    order = ["leader", "vec_id", "row_no"]
    dealt = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(cut, "shard int, ids binary, rows binary, terms binary, top binary, bottom binary")


def search_tile(queries, query_rows, blocks: list[tuple], k: int):
    """``(query, vec_id, score)`` arrays of the best ``k`` of a shard for each query but its own row. Blocks: ``(ids, rows, terms, top, bottom)``."""
    import numpy as np

    top, bottom = np.array([b[3] for b in blocks]), np.array([b[4] for b in blocks])
    # Terms of both signs side by side: a term adds its value times the block's largest or, if negative, smallest.
    bound = _product(np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1), np.concatenate([top, bottom], axis=1), bound=True)
    order = np.argsort(-bound, axis=1, kind="stable")
    least, last = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    scores, ids = np.full((len(queries), k), least), np.full((len(queries), k), last)
    active = np.arange(len(queries))
    for turn in range(len(blocks)):
        at = order[active, turn]
        go = bound[active, at] >= scores[active, k - 1]
        active, at = active[go], at[go]
        if not len(active):
            break
        by_block = np.argsort(at, kind="stable")
        for part in np.split(by_block, np.flatnonzero(np.diff(at[by_block])) + 1):
            who, (b_ids, b_rows, b_terms, _, _) = active[part], blocks[at[part[0]]]
            found = _product(queries[who], b_terms)
            found[b_rows[None, :] == query_rows[who][:, None]] = least
            hit = found.max(axis=1) >= scores[who, k - 1]
            who, found = who[hit], found[hit]
            all_scores = np.concatenate([scores[who], found], axis=1)
            all_ids = np.concatenate([ids[who], np.broadcast_to(b_ids, found.shape)], axis=1)
            all_ids = np.where(all_scores == least, last, all_ids)
            best = np.lexsort((all_ids, -all_scores.astype(np.float64) if abs(int(all_scores.max(initial=0))) < 1 << 53 else ~all_scores), axis=1)[:, :k]
            scores[who] = np.take_along_axis(all_scores, best, axis=1)
            ids[who] = np.take_along_axis(all_ids, best, axis=1)
    query, place = np.nonzero(ids != last)
    return query, ids[query, place], scores[query, place]


def search(vectors: DataFrame, scratch: Scratch, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """The ``k`` best of every query: ``query_id, rank, vec_id, score``.

    Queries: rows whose vec_id is divisible by ``every``; every row but the query's own is a candidate, also rows that repeat its id. Vectors of
    unequal length are compared over their common components. Other columns are ignored; an empty table gives no rows.
    """
    rows = scratch.save(quantised(vectors, scale), "vectors")
    total, asking, longest = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.length("terms"))).first()
    width, groups = max(1, (longest or 0) // 8), max(1, -(-asking // QUERIES))
    leaders = [bytes(r[0]) for r in rows.orderBy(F.xxhash64("vec_id", "row_no")).limit(LEADERS).select("terms").collect()]
    shards = max(1, -(-total // SHARD))
    blocks = scratch.save(forward_blocks(rows, leaders, width, shards), "blocks")
    none = F.lit(None).cast("binary")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("row_no"), F.lit(groups)).cast("int").alias("group"),
        F.col("row_no").alias("query"), "vec_id", none.alias("ids"), none.alias("rows"), "terms", none.alias("top"), none.alias("bottom"),
    )
    empty = F.lit(None).cast("long")
    sides = blocks.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), empty.alias("query"), empty.alias("vec_id"), "ids", "rows", "terms", "top", "bottom"
    )

    def tile(key, table):
        import numpy as np
        import pyarrow as pa

        parts = table.to_pylist()
        asked = sorted((r for r in parts if r["ids"] is None), key=lambda r: r["query"])
        there = [r for r in parts if r["ids"] is not None]
        names, kinds = ["query", "query_id", "vec_id", "score"], [pa.int64()] * 4
        if not asked or not there:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
        unpack = lambda r: [np.frombuffer(r[c], "<i8") for c in ("ids", "rows", "terms", "top", "bottom")]
        made = [(i, n, t.reshape(-1, width), a, b) for i, n, t, a, b in map(unpack, there)]
        own = np.array([r["vec_id"] for r in asked], np.int64)
        numbers = np.array([r["query"] for r in asked], np.int64)
        query, ids, scores = search_tile(_matrix([r["terms"] for r in asked], width), numbers, made, k)
        return pa.Table.from_arrays([pa.array(numbers[query]), pa.array(own[query]), pa.array(ids), pa.array(scores)], names=names)

    found = queries.unionByName(sides).groupBy("shard", "group").applyInArrow(tile, "query long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.r <> q.r)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= {K}
"""
