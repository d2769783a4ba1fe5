"""Exact money: the double-to-decimal boundary, rounding and proration.

Money arrives as double precision and leaves as ``decimal(20,2)``. Sums and differences are taken on
decimals, so their result does not depend on the order in which Spark adds partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(20,2)"
NUMERIC = "decimal(38,18)"
AMOUNT = "decimal(24,10)"


def numeric(c: Column) -> Column:
    """Double to decimal with 15 significant digits, so that ``0.1 + 0.2`` becomes ``0.3``.

    A double next to a number of four decimals, below 10^10, is that number: it has at most 14 digits, and no other number of 15 is as
    near. Only the others pay for the text conversion.
    """
    x = c.cast("double")
    parts = F.rint(x * F.lit(10000.0))
    plain = (F.abs(x) < F.lit(1e10)) & (parts / F.lit(10000.0) == x)
    exact = parts.cast("bigint").cast("decimal(14,0)") * F.lit("0.0001").cast("decimal(4,4)")
    return F.when(plain, exact.cast(NUMERIC)).when(c.isNotNull(), F.format_string("%.14e", x).cast(NUMERIC))


def money(c: Column) -> Column:
    """Decimal rounded to cents, half away from zero, as a decimal cast does."""
    return c.cast(MONEY)


def money_from_double(c: Column) -> Column:
    """Double rounded to cents, half away from zero, on its first 15 significant digits.

    Only values next to half a cent can differ between the plain cast and the 15-digit rule, so only
    those pay for the text conversion.
    """
    x = c.cast("double")
    cents = F.abs(x) * F.lit(100.0)
    off_tie = F.abs(cents - F.floor(cents).cast("double") - F.lit(0.5))
    near = off_tie < F.lit(1e-6) + cents * F.lit(1e-12)
    return F.when(near, money(numeric(x))).otherwise(x.cast(MONEY))


def zero(c: Column) -> Column:
    """NULL money counts as 0."""
    return F.coalesce(c, F.lit(0).cast(MONEY))


def ratio(a: Column, b: Column, c: Column) -> Column:
    """``a * b / c`` in double precision; NULL when ``c`` is 0."""
    d = c.cast("double")
    return a.cast("double") * b.cast("double") / F.nullif(d, F.lit(0.0))


def share(a: Column, b: Column, c: Column) -> Column:
    """``a * b / c`` in cents; NULL when ``c`` is 0 or any input is NULL."""
    return money_from_double(ratio(a, b, c))


def share_unrounded(a: Column, b: Column, c: Column) -> Column:
    """``a * b / c`` as a 15-digit decimal, for sums that are rounded once at the end."""
    return numeric(ratio(a, b, c))


def at_least(c: Column, floor: float | Column) -> Column:
    """Larger of the two; a NULL side is skipped."""
    return F.greatest(c, floor if isinstance(floor, Column) else F.lit(floor))


def neg(c: Column) -> Column:
    return -c


def decimal_amounts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn double columns into decimals once, where a table enters the reports.

    ``columns`` defaults to every floating-point column; columns that already are decimals stay.
    """
    floating = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)
    ]
    if not floating:
        return df
    return df.withColumns({n: numeric(F.col(n)).cast(AMOUNT) for n in floating})
