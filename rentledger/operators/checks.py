"""Data-quality checks as frames, so that their result can be stored or asserted on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_long
from .projection import quoted


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys; they differ where a join fanned out."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(quoted(key)).alias("n_keys"))


def coverage(stages: dict[str, DataFrame], key: str) -> DataFrame:
    """Distinct keys that survive each step, one row per step."""
    rows = [
        df.agg(F.countDistinct(quoted(key)).alias("n_keys")).select(F.lit(name).alias("stage"), "n_keys")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def missing_ids(report: DataFrame, ids: DataFrame, label: str = "Order Id", id_col: str = "order_number") -> DataFrame:
    """Expected ids the report does not have."""
    present = report.select(as_long(quoted(label), strict=False).alias(id_col))
    return ids.join(present, id_col, "left_anti")


def trace(stages: dict[str, DataFrame], key: str, value) -> dict[str, DataFrame]:
    """Rows of one key in every step."""
    return {name: df.filter(quoted(key) == F.lit(value)) for name, df in stages.items()}
