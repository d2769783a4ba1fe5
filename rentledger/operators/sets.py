"""Stacking of frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from .projection import quoted


def stack(first: DataFrame, second: DataFrame, schema: dict[str, str] | None = None) -> DataFrame:
    """All rows of both, matched by column name; ``schema`` casts both sides first."""
    if schema:
        first, second = (
            df.select([quoted(n).cast(t).alias(n) for n, t in schema.items()]) for df in (first, second)
        )
    return first.unionByName(second)


def stack_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*[quoted(c) for c in order]).limit(n)


def sort_report(df: DataFrame, label: str) -> DataFrame:
    """Report in line-item order; done once, at the sink."""
    return df.orderBy(quoted(label))


__all__ = ["preview", "sort_report", "stack", "stack_all"]
