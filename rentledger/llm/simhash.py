"""SimHash near-dedup: fingerprints, and exact pairs within a Hamming distance by vantage-point trees.

Equal fingerprints are one point. A tree fitted on a bounded sample of points cuts the space into shards: at each node, points
within a radius of the vantage point go one way, the others the other way. Every point has one home shard. By the
triangle inequality a partner within ``distance`` of a point can only live in shards whose border the point is near; the point
is sent there as well, and to no other. Inside a shard the same pruning goes on in memory until the sides are small
enough to compare. A shard reports a forest of links, not all pairs, so a large group of near copies stays linear.
Links over all shards are then joined to components by contraction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, numbered, row_number, type_of
from .tokens import text_batches

WORDS = 3
SEED = 42
DISTANCE = 3
# Points of a shard that are at home there; larger ones are compared block by block.
SHARD = 40_000
# Points that the tree is fitted on: so many for each shard, and at most this many in all.
SAMPLE_PER_SHARD, SAMPLE = 64, 65_536
# Sides whose product is below this are compared directly.
DIRECT = 1 << 21


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles: unsigned, repeats count, no words give 0."""
    import numpy as np
    from xxhash import xxh64_digest

    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[words - 1 :].tolist() or [len(joined)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(ends), 1 << 15):
        part = b"".join([xxh64_digest(joined[a:b], seed) for a, b in zip(starts[i : i + (1 << 15)], ends[i : i + (1 << 15)])])
        counts += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED, number: str | None = None) -> DataFrame:
    """``doc_id, row_no, fp`` of whole texts; ``fp`` is the fingerprint as a signed long. Null text counts as empty."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for batch in text_batches(whole, 1024):
                made = [fingerprint(t or "", words, seed) for t in batch.column(2).to_pylist()]
                fp = pa.array(np.array(made, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], names=["doc_id", "row_no", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_number(number), "text")
    return rows.mapInArrow(run, f"doc_id long, row_no {type_of(rows, 'row_no')}, fp long")


def hex_digits(fp: Column) -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Node(NamedTuple):
    """An inner node of a tree; ``near`` and ``far`` are nodes, or numbers of shards."""

    vantage: int
    radius: int
    near: Node | int
    far: Node | int


def best_cut(points, distance: int, tries: int = 8):
    """``(vantage, radius, distances)`` that leaves fewest points near the border; None if nothing separates them."""
    import numpy as np

    best = None
    for k in range(0, len(points), max(1, len(points) // tries)):
        d = np.bitwise_count(points ^ points[k])
        radius = int(np.median(d))
        near = int((d <= radius).sum())
        if near == len(points):
            radius = int(d.max()) - 1
            near = int((d <= radius).sum())
        if not 0 < near < len(points):
            continue
        border = int(((d > radius - distance) & (d <= radius + distance)).sum())
        cost = near * int((d <= radius + distance).sum()) + (len(points) - near) * int((d > radius - distance).sum())
        if best is None or (cost, border) < best[0]:
            best = (cost, border), points[k], radius, d
    return best[1:] if best else None


def fit(sample, shards: int, distance: int) -> tuple[Node | int, int]:
    """A tree with at most ``shards`` shards over a sample of points, and the number of shards it has."""
    made = 0

    def grow(points, want: int) -> Node | int:
        nonlocal made
        cut = best_cut(points, distance) if want > 1 and len(points) > 1 else None
        if cut is None:
            made += 1
            return made - 1
        vantage, radius, d = cut
        near = grow(points[d <= radius], want // 2)
        return Node(int(vantage), radius, near, grow(points[d > radius], want - want // 2))

    return grow(sample, shards), made


def route(tree: Node | int, points, distance: int):
    """``(shard, index, home)`` arrays: the home of every point, and later shards that may hold a partner.

    A pair over two shards is found in the later one, so points are sent to shards with a higher number only.
    """
    import numpy as np

    every = np.arange(len(points))
    home, visits, todo = np.zeros(len(points), np.int64), [], [(tree, every, every)]
    while todo:
        node, own, near = todo.pop()
        if not isinstance(node, Node):
            home[own] = node
            visits.append((node, near))
            continue
        vantage = np.uint64(node.vantage)
        d_own, d_near = np.bitwise_count(points[own] ^ vantage), np.bitwise_count(points[near] ^ vantage).astype(np.int64)
        todo.append((node.near, own[d_own <= node.radius], near[d_near <= node.radius + distance]))
        todo.append((node.far, own[d_own > node.radius], near[d_near > node.radius - distance]))
    shard = np.concatenate([np.full(len(i), s, np.int64) for s, i in visits])
    index = np.concatenate([i for _, i in visits])
    keep = shard >= home[index]
    shard, index = shard[keep], index[keep]
    return shard, index, shard == home[index]


def link(points, home, distance: int):
    """``(index, root)`` of the points of a shard that are linked to another, by pairs with at least one at home."""
    import numpy as np

    root = np.arange(len(points))

    def unite(a, b) -> None:
        while True:
            a, b = root[a], root[b]
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def compare(own, near) -> None:
        for i in range(0, len(near), 1024):
            part = near[i : i + 1024]
            for j in range(0, len(own), 1024):
                a, b = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[own[j : j + 1024]][None, :]) <= distance)
                if len(a):
                    unite(part[a], own[j : j + 1024][b])

    todo = [(np.flatnonzero(home), np.arange(len(points)))]
    while todo:
        own, near = todo.pop()
        cut = best_cut(points[own[:: max(1, len(own) // 512)]], distance) if len(own) * len(near) > DIRECT and len(own) > 256 else None
        if cut is None:
            compare(own, near)
            continue
        d_own, d_near = np.bitwise_count(points[own] ^ cut[0]), np.bitwise_count(points[near] ^ cut[0]).astype(np.int64)
        todo.append((own[d_own <= cut[1]], near[d_near <= cut[1] + distance]))
        todo.append((own[d_own > cut[1]], near[d_near > cut[1] - distance]))
    linked = np.flatnonzero(root != np.arange(len(points)))
    return linked, root[linked]


def links(points: DataFrame, scratch: Scratch, distance: int = DISTANCE, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``a, b``: a forest of links between distinct fingerprints ``fp`` at most ``distance`` apart, complete for connectivity."""
    total = points.count()
    shards = max(1, min(-(-total // shard), sample // SAMPLE_PER_SHARD))
    # The sample: fingerprints with the smallest hashes, the same on every run.
    chosen = points.orderBy(F.xxhash64("fp"), "fp").limit(min(sample, shards * SAMPLE_PER_SHARD)) if shards > 1 else points.limit(0)
    import numpy as np

    tree, made = fit(np.array([r[0] for r in chosen.collect()], np.int64).view(np.uint64), shards, distance)

    def send(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy()
            where, index, home = route(tree, fps.view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(fps[index]), pa.array(home)], names=["shard", "fp", "home"])

    sent = scratch.save(points.select("fp").mapInArrow(send, "shard long, fp long, home boolean"), "sent")
    # A shard that holds more than it should, at home or as visitors, is split into blocks, and all pairs of blocks are compared.
    sides = sent.groupBy("shard").agg(F.count_if("home").alias("own"), F.count("*").alias("all"))
    blocks = sides.select(
        F.col("shard").alias("_shard"),
        F.ceil(F.col("own") / (2 * shard)).cast("int").alias("rows"),
        F.ceil(F.col("all") / (8 * shard)).cast("int").alias("columns"),
    )
    rows = sent.join(blocks, F.col("shard") == F.col("_shard")).where("rows > 0")
    salt = F.xxhash64("fp", F.lit(7))
    every = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: F.struct(r.alias("row"), F.pmod(salt, F.col("columns")).cast("int").alias("column"), F.lit(False).alias("own")))
    own = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda c: F.struct(F.pmod(salt, F.col("rows")).cast("int").alias("row"), c.alias("column"), F.lit(True).alias("own")))
    cells = rows.select("shard", "fp", F.explode(F.when(F.col("home"), F.concat(own, every)).otherwise(every)).alias("cell"))

    def pairs(key, frame):
        import numpy as np
        import pandas as pd

        frame = frame.groupby("fp", as_index=False)["own"].max()
        fps = frame["fp"].to_numpy()
        index, root = link(fps.view(np.uint64), frame["own"].to_numpy(bool), distance)
        return pd.DataFrame({"a": fps[index], "b": fps[root]})

    return cells.select("shard", "fp", "cell.*").groupBy("shard", "row", "column").applyInPandas(pairs, "a long, b long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label`` of every node of the edges ``a, b``; the label is the smallest node of the component.

    Rounds of contraction: every node draws a number, new in each round, and hooks onto the neighbour with the smallest one if that is
    below its own; so at least half of the nodes are expected to hook, whatever the graph. Hooks are followed to their roots
    by pointer jumping, edges are drawn between roots, and what remains is the next, smaller graph. The rounds grow with the
    logarithm of the nodes, also along a chain. All tables are written, so both sides of every join are plain shuffles, which
    Spark splits at a hot node, and no round holds more edges than the one before.
    """
    plain = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    plain, levels = scratch.save(plain, "edges0"), []
    while plain.limit(1).count():
        k = len(levels)
        both = plain.select("a", "b").union(plain.select("b", "a"))
        drawn = F.struct(F.xxhash64("b", F.lit(k)), "b")
        low = both.groupBy("a").agg(F.min(drawn).alias("low"))
        parent = F.when(F.col("low") < F.struct(F.xxhash64("a", F.lit(k)), "a"), F.col("low.b")).otherwise(F.col("a"))
        level, j = scratch.save(low.select(F.col("a").alias("node"), parent.alias("parent")), f"level{k}-0"), 0
        while True:
            up = level.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
            jumped = level.join(up, "parent").select("node", F.col("up").alias("parent"), (F.col("up") != F.col("parent")).alias("moved"))
            jumped, j = scratch.save(jumped, f"level{k}-{j + 1}"), j + 1
            scratch.drop(f"level{k}-{j - 1}")
            level = jumped.select("node", "parent")
            if not jumped.where("moved").limit(1).count():
                break
        levels.append(level)
        ends = plain.join(level.select(F.col("node").alias("a"), F.col("parent").alias("x")), "a")
        ends = ends.join(level.select(F.col("node").alias("b"), F.col("parent").alias("y")), "b")
        rest = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        plain = scratch.save(rest, f"edges{k + 1}")
        scratch.drop(f"edges{k}")
    if not levels:
        return plain.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = levels.pop()
    while levels:
        level = levels.pop()
        above = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        roots = level.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent"))
        roots = scratch.save(roots, f"roots{len(levels)}")
    least = scratch.save(roots.groupBy("parent").agg(F.min("node").alias("label")), "least")
    return scratch.save(roots.join(least, "parent").select("node", "label"), "labels")


def near_groups(
    docs: DataFrame, scratch: Scratch, words: int = WORDS, seed: int = SEED, distance: int = DISTANCE, number: str | None = None
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id, row_no, keep_row``.

    ``component_id`` is the smallest doc_id reachable over fingerprints at most ``distance`` bits apart, null if none there has one;
    ``keep_row`` is the row_no of the document that a dedup keeps. Empty and null texts have fingerprint 0 and are linked
    like any other; an empty table gives no rows. Other columns are ignored.
    """
    prints = scratch.save(fingerprints(docs, words, seed, number), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_no")).alias("first")
    points = scratch.save(prints.groupBy("fp").agg(first), "points")
    labels = components(links(points, scratch, distance), scratch)
    scratch.drop("sent")
    labelled = points.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    labelled = scratch.save(labelled, "labelled")
    heads = labelled.groupBy("label").agg(F.min("first").alias("head"))
    heads = scratch.save(labelled.join(heads, "label").select("fp", F.col("head.doc_id").alias("component_id"), F.col("head.row_no").alias("keep_row")), "heads")
    return prints.join(heads, "fp").select("doc_id", "fp", "component_id", "row_no", "keep_row")


def keep_one(docs: DataFrame, scratch: Scratch, **rules) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns."""
    rows, number = numbered(docs, scratch)
    stays = near_groups(rows, scratch, number=number, **rules).where("row_no = keep_row").select(F.col("row_no").alias(number))
    return rows.join(stays, number, "left_semi").drop(number)
