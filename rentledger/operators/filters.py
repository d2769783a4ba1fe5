"""Row filters of the reports. All are plain predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import quoted

PRODUCT_SCOPE = 0
LOCATION_SCOPE = 1


def drop_alacarte_roots(df: DataFrame, parent: str, flag: str) -> DataFrame:
    """Drop a-la-carte items that have no parent.

    A row with neither parent nor flag is dropped as well: the predicate is NULL there.
    """
    return df.filter(no_alacarte_root(parent, flag))


def no_alacarte_root(parent: str, flag: str) -> Column:
    """TRUE for rows that stay, FALSE or NULL for the others."""
    return ~(quoted(parent).isNull() & (quoted(flag) == F.lit(True)))


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(quoted(col) > 0)


def require(df: DataFrame, col: str) -> DataFrame:
    return df.filter(quoted(col).isNotNull())


def exported(df: DataFrame, flag: str = "ShowInExport") -> DataFrame:
    return df.filter(quoted(flag) == F.lit(True))


def live(df: DataFrame, deleted_flag: str = "IsDeleted") -> DataFrame:
    """Rows marked as not deleted; an unknown flag drops the row."""
    return df.filter(quoted(deleted_flag) == F.lit(False))


def scope(df: DataFrame, type_col: str, code: int) -> DataFrame:
    return df.filter(quoted(type_col) == code)


def lookup(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(quoted(col) == F.lit(value))


def split_by_refund_id(df: DataFrame, col: str, unset: int | None = 0) -> tuple[DataFrame, DataFrame]:
    """``(refund rows, payment rows)``; payment rows carry ``unset`` (0, or None for NULL)."""
    c = quoted(col)
    if unset is None:
        return df.filter(c.isNotNull()), df.filter(c.isNull())
    return df.filter(c != unset), df.filter(c == unset)
