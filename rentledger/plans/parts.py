"""Reports over very many items, in parts that are written one after the other.

Shuffle files of a plan stay on disk until it ends, and a report moves its lines several times. Here the items are dealt into parts by a
hash of their id, with all that hangs on an item by that id. A part is a whole report of its items; when it is written its shuffle
files go, so the disk holds those of one part. What is known per order is worked out once and written for all parts.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.projection import quoted
from ..sources.snapshot import checkpoint_stage, new_stage, stage_root, write_step
from ..sources.versions import drop_table

# Tables that reports join by the item, with the item's id in them.
ITEM_KEYS = {"OrderItems": "Id", "OrderItemsHistory": "OrderItemId", "OrderCoupons": "OrderItemId", "OrderItemDynamicControls": "OrderItemId"}
# Items of a part; a report of no more is not parted. An item takes up to 900 bytes of shuffle files.
ITEMS_OF_A_PART = 16_000_000
# Items that Spark takes for fewer bytes than this are not counted: they are one part.
SMALL_BYTES = 64 << 20


class Part(dict):
    """Tables with the rows of every ``parts``-th item only, by the hash of its id; tables without items are whole."""

    def __init__(self, tables: dict[str, DataFrame], number: int, parts: int):
        super().__init__()
        self.tables, self.number, self.parts = tables, number, parts

    def __missing__(self, name: str) -> DataFrame:
        df = self.tables[name]
        if name in ITEM_KEYS:
            # Rows without an id have a hash as well and stay together.
            df = df.where(F.pmod(F.xxhash64(quoted(ITEM_KEYS[name])), F.lit(self.parts)) == self.number)
        self[name] = df
        return df


def parts_of(tables: dict[str, DataFrame], dynamic: bool = False) -> int:
    """Number of parts of ``ITEMS_OF_A_PART`` items at most, but for the unevenness of their hashes.

    1 also where ids have several types, so that equal ids might differ in their hash, or where no folder for steps is known.
    """
    items = tables["OrderItems"]
    if items._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SMALL_BYTES:
        return 1
    names = [n for n in ITEM_KEYS if dynamic or n != "OrderItemDynamicControls"]
    types = [tables[n].schema[ITEM_KEYS[n]].dataType for n in names]
    if any(t != types[0] for t in types) or not (types[0] == T.StringType() or isinstance(types[0], T.IntegralType)):
        return 1
    if stage_root(items.sparkSession) is None:
        return 1
    return max(1, math.ceil(items.count() / ITEMS_OF_A_PART))


def in_parts(
    tables: dict[str, DataFrame],
    parts: int,
    header: DataFrame,
    build: Callable[[Part, DataFrame], DataFrame],
    stage: str | None = None,
    rest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``build(part, header)`` of every part, written to ``stage`` or below ``spark.checkpoint.dir`` and read back.

    ``header`` is what is known per order; it is written first and dropped at the end. ``rest(header)`` is what no item has.
    """
    spark = header.sparkSession
    known, path = new_stage(spark, "orders"), stage or new_stage(spark, "report")
    header = checkpoint_stage(header, known)
    for n in range(parts):
        rows = build(Part(tables, n, parts), header)
        write_step(rows, path, "append" if n else "overwrite")
    if rest is not None:
        write_step(rest(header), path, "append")
    drop_table(spark, known)
    return spark.read.schema(rows.schema).parquet(path)
