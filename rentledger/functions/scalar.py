"""Text, flag and type helpers used by the report columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
WEB_SOURCE = "Consumer Web"


def const(value, dtype: str = "string") -> Column:
    """Literal of a stated type; ``const(None, "string")`` is a typed NULL."""
    return F.lit(value).cast(dtype)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def default(c: Column, value: str) -> Column:
    return F.coalesce(c, F.lit(value))


def first_non_null(*cs: Column) -> Column:
    return F.coalesce(*cs)


def text(c: Column) -> Column:
    """Text form; decimals keep their scale (``0.00``)."""
    return c.cast("string")


def uuid(c: Column) -> Column:
    """Normalised uuid text, NULL where the input is not a uuid."""
    cleaned = F.lower(F.trim(c))
    return F.when(cleaned.rlike(UUID_PATTERN), cleaned)


def as_long(c: Column, strict: bool = True) -> Column:
    """Text to bigint: an error on bad text when strict, else NULL."""
    return c.cast("bigint") if strict else c.try_cast("bigint")


def flag_text(b: Column) -> Column:
    return F.when(b, F.lit("TRUE")).when(~b, F.lit("FALSE"))


def full_name(first: Column, last: Column) -> Column:
    """First and last name; a missing part is empty, so a missing user is one blank."""
    return F.concat(blank(first), F.lit(" "), blank(last))


def mask_user(source: Column, name: Column) -> Column:
    """No user name on orders the customer placed on the web."""
    return F.when(source == WEB_SOURCE, F.lit("")).otherwise(blank(name))


def partner_text(partner_id: Column) -> Column:
    """Partner id as text; 0 and NULL are blank."""
    return F.when(partner_id == 0, F.lit("")).otherwise(blank(partner_id.cast("string")))


def clean_name(c: Column) -> Column:
    """Control name without double quotes, fit for a column name."""
    return F.translate(c, '"', "")


def refunded_flag(refunded: Column, fallback: Column) -> Column:
    return F.when(refunded > 0, F.lit(True)).otherwise(fallback)


def actual_amount(refunded: Column, before_refund: Column, current: Column) -> Column:
    """Amount originally charged: the one before the first refund where there was a refund."""
    return F.when(refunded > 0, before_refund).otherwise(current)


def pick(refunded: Column, current: Column, before_refund: Column) -> Column:
    """Current item value while nothing is refunded, else the value before the first refund."""
    return F.when(refunded == 0, current).otherwise(before_refund)
