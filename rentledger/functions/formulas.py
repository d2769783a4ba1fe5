"""Report formulas as column functions. Inputs are decimals unless stated otherwise."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .money import at_least, money, money_from_double, neg, ratio, share, share_unrounded, zero


def final_subtotal(total: Column, coupon: Column, discount: Column, floor: float | None = None) -> Column:
    """Line total less coupon and discount, optionally not below ``floor``."""
    net = total - coupon - discount
    return net if floor is None else at_least(net, floor)


def create_fee(fee: Column, actual: Column, paid: Column) -> Column:
    """Share of the payment's processor fee that falls on this line."""
    return share(fee, actual, paid)


def refund_ratio(fee: Column, refunded: Column, total_refund: Column) -> Column:
    """Unrounded share of the returned processor fee; 0 where fee or refund is 0, NULL where no total exists."""
    nothing = (fee == 0) | (refunded == 0)
    return F.when(nothing, F.lit(0.0)).otherwise(ratio(fee, refunded, total_refund))


def refund_fee(fee: Column, refunded: Column, total_refund: Column) -> Column:
    """``refund_ratio`` in cents."""
    return money_from_double(refund_ratio(fee, refunded, total_refund))


def refund_fee_signed(fee: Column, refunded: Column, total_refund: Column) -> Column:
    """Returned fee as shown on refund rows: negative."""
    return neg(share(fee, refunded, total_refund))


def total_fee(create: Column, refund: Column) -> Column:
    return money(create - refund)


def _total(*terms: Column) -> Column:
    return reduce(add, terms)


def collected_order(
    tip: Column, subtotal: Column, booking: Column, tax: Column, delivery: Column, create: Column, refund: Column
) -> Column:
    """What the line brought in after processor fees; 0.00 where any part is unknown."""
    return zero(money(_total(tip, subtotal, booking, tax, delivery) - (create - refund)))


def collected_payment(
    tip: Column, subtotal: Column, booking: Column, tax: Column, delivery: Column, create: Column
) -> Column:
    """As ``collected_order``, before refunds."""
    return zero(money(_total(tip, subtotal, booking, tax, delivery) - create))


def collected_refund(
    tip: Column, subtotal: Column, booking: Column, tax: Column, delivery: Column, fee: Column
) -> Column:
    """Money given back by one refund event.

    Inputs are the already signed event columns and the unrounded signed fee. A missing subtotal makes
    the result 0.00, every other missing part counts as 0.
    """
    parts = _total(zero(tip), subtotal, zero(booking), zero(tax), zero(delivery))
    return zero(money(parts - F.coalesce(fee, F.lit(0).cast("decimal(38,18)"))))


def refund_share_unrounded(fee: Column, refunded: Column, total_refund: Column) -> Column:
    return neg(share_unrounded(fee, refunded, total_refund))


def refund_signs(df: DataFrame, negated: list[str]) -> DataFrame:
    """Turn the named columns of a refund frame into deductions."""
    return df.withColumns({n: neg(F.col(n)) for n in negated})


# --- first-generation formulas: double precision, not rounded -------------------------------------


def _part(amount: Column, total: Column) -> Column:
    return amount / F.nullif(total, F.lit(0.0))


def fees_by_order_total(fee: Column, refunded_fee: Column, amount: Column, total: Column) -> tuple[Column, Column, Column]:
    """Create, refund and total fee by the item's part of the order total. The total adds the refund."""
    part = _part(amount, total)
    return (
        fee * part,
        refunded_fee * part,
        (fee + F.coalesce(refunded_fee, F.lit(0.0))) * part,
    )


def booking_share(fee: Column, amount: Column, total: Column) -> Column:
    return ratio(fee, amount, total)


def collected_level(paid: Column, order_refund: Column, refunded_fee: Column) -> Column:
    """Order-level amount, the same on every line of the order."""
    return paid - order_refund - F.coalesce(refunded_fee, F.lit(0.0))


def collected_share(paid: Column, order_refund: Column, refunded_fee: Column, amount: Column, total: Column) -> Column:
    """``collected_level`` prorated to the line; missing amounts count as 0."""
    nil = F.lit(0.0)
    net = F.coalesce(paid, nil) - F.coalesce(order_refund, nil) - F.coalesce(refunded_fee, nil)
    return net * amount / F.nullif(total, nil)


__all__ = [
    "booking_share",
    "collected_level",
    "collected_order",
    "collected_payment",
    "collected_refund",
    "collected_share",
    "create_fee",
    "fees_by_order_total",
    "final_subtotal",
    "refund_fee",
    "refund_fee_signed",
    "refund_ratio",
    "refund_share_unrounded",
    "refund_signs",
    "total_fee",
]
