"""Aggregations that bring a one-to-many table down to one row per key.

Every one of them combines on the map side, so a key that holds a large part of the rows sends one
partial result per task through the shuffle, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import money
from .filters import positive
from .projection import quoted


def refund_totals(history: DataFrame, out: str = "sum_refunded") -> DataFrame:
    """Refunded amount per item over all its refund events."""
    return (
        positive(history, "RefundedTotalAmount")
        .groupBy(F.col("OrderItemId").alias("order_item_id"))
        .agg(F.sum("RefundedTotalAmount").alias(out))
    )


def event_order(time: str = "CreatedOn", tiebreak: str = "Id") -> Column:
    """Sort key of refund events: by time, unknown times last, ties by id."""
    return F.struct(F.col(time).isNull(), F.col(time), F.col(tiebreak))


def first_by(df: DataFrame, key: str, values: dict[str, str], time: str = "CreatedOn", tiebreak: str = "Id") -> DataFrame:
    """Values of the earliest row per key; a NULL value of that row is kept.

    ``values`` maps source columns to output names.
    """
    first = F.min_by(F.struct(*[F.col(c).alias(n) for c, n in values.items()]), event_order(time, tiebreak))
    return df.groupBy(key).agg(first.alias("_first")).select(key, "_first.*")


def payment_refunds(refunds: DataFrame, payments: DataFrame | None = None, round_to_cents: bool = False) -> DataFrame:
    """Refunded amount and returned fee per payment.

    With ``payments``, refunds of unknown payments are left out; they are summed up first, so the join
    sees one row per payment.
    """
    total, fee = F.sum("Amount"), F.sum("RefundedProcessingFee")
    if round_to_cents:
        total, fee = money(total), money(fee)
    sums = refunds.groupBy(F.col("PaymentTransactionId").alias("payment_transaction_id")).agg(
        total.alias("sum_total_refund_amount"), fee.alias("sum_refunded_processing_fee")
    )
    if payments is None:
        return sums
    known = payments.select(F.col("Id").alias("payment_transaction_id"))
    return sums.join(known, "payment_transaction_id", "left_semi")


def joined_values(bundle: Column, sep: str) -> Column:
    """Sorted text list from an array of ``(value, n)``, each value ``n`` times; NULL if there is none."""
    repeated = F.transform(F.array_sort(bundle), lambda x: F.array_repeat(x["value"], x["n"].cast("int")))
    return F.when(F.size(bundle) > 0, F.array_join(F.flatten(repeated), sep))


def _value_bundle(value: str, n: str) -> Column:
    pair = F.struct(F.col(value).alias("value"), F.col(n).alias("n"))
    return F.collect_list(F.when(F.col(value).isNotNull(), pair))


def merge_values(attrs: DataFrame, keys: list[str], value: str, out: str, sep: str = ", ") -> DataFrame:
    """All values per key as one sorted list, duplicates kept.

    Equal values are counted first: what is gathered per key is bounded by its distinct values.
    """
    counted = attrs.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    bundled = counted.groupBy(*keys).agg(_value_bundle(value, "_n").alias("_bundle"))
    return bundled.select(*keys, joined_values(F.col("_bundle"), sep).alias(out))


def coupon_codes(order_coupons: DataFrame, coupons: DataFrame, how: str = "inner", sep: str = ",") -> DataFrame:
    """Ordered list of coupon codes per item.

    ``how="left"`` keeps items whose coupons are all unknown, with a NULL list. Uses of one coupon on
    one item are counted before the join to the coupons.
    """
    used = order_coupons.groupBy(F.col("OrderItemId").alias("order_item_id"), "CouponId").agg(
        F.count(F.lit(1)).alias("_n")
    )
    codes = coupons.select(F.col("Id").alias("CouponId"), F.col("CouponCode").alias("_code"))
    bundled = (
        used.join(codes, "CouponId", how)
        .groupBy("order_item_id")
        .agg(_value_bundle("_code", "_n").alias("_bundle"))
    )
    return bundled.select("order_item_id", joined_values(F.col("_bundle"), sep).alias("coupon_code"))


def dedupe(df: DataFrame) -> DataFrame:
    return df.distinct()


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """One row, also for an empty table."""
    return df.agg(F.count(F.lit(1)).alias(out))


def key_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct values of several columns in one pass; ``columns`` maps them to output names."""
    return df.agg(*[F.countDistinct(quoted(c)).alias(n) for c, n in columns.items()])


__all__ = [
    "coupon_codes",
    "dedupe",
    "event_order",
    "first_by",
    "joined_values",
    "key_counts",
    "merge_values",
    "payment_refunds",
    "refund_totals",
    "row_count",
]
