"""Renames, labels and column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its exact name; report labels hold blanks, ``%``, ``?`` and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, in mapping order."""
    return df.select([quoted(old).alias(new) for old, new in mapping.items()])


def label(df: DataFrame, pairs: list[tuple[str | Column, str]]) -> DataFrame:
    """Select expressions under report labels, in list order."""
    return df.select([(quoted(e) if isinstance(e, str) else e).alias(name) for e, name in pairs])


def extend(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns so far plus new ones."""
    return df.withColumns(columns)


def drop_keys(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop helper columns; names that do not exist are ignored."""
    return df.drop(*names)


def move_column(df: DataFrame, name: str, ordinal: int) -> DataFrame:
    """Put a column in front of the one that is ``ordinal``-th (from 1) without it."""
    if name not in df.columns:
        return df
    names = [c for c in df.columns if c != name]
    names.insert(min(ordinal - 1, len(names)), name)
    return df.select([quoted(c) for c in names])


def blank_nulls(df: DataFrame) -> DataFrame:
    """Every column as text, NULL as an empty string."""
    return df.select([F.coalesce(quoted(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
