"""Joins of the reports.

No join carries a broadcast hint. Spark broadcasts a side when its size, as estimated or as measured at
run time, is below ``spark.sql.autoBroadcastJoinThreshold``; a larger side is joined by shuffle, where a
hot key is split (see ``session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_long
from .filters import drop_alacarte_roots, no_alacarte_root
from .projection import quoted


def enrich(df: DataFrame, dim: DataFrame, fk: str, pk: str, columns: dict[str, str | Column]) -> DataFrame:
    """Left-join a dimension; ``columns`` maps new names to dimension columns or expressions on it."""
    key = f"_{fk}_key"
    side = dim.select(
        quoted(pk).alias(key),
        *[(quoted(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()],
    )
    return df.join(side, quoted(fk) == F.col(key), "left").drop(key)


def base_lines(orders: DataFrame, reservations: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with reservation code and items, order-driven; inputs are in model names.

    Where roots are dropped afterwards, orders without items go too and Spark plans an inner join.
    """
    coded = enrich(orders, reservations, "reservation_id", "Id", {"reservation_code": "ReservationCode"})
    return coded.join(items, "order_id", "left")


def lines_from_items(items: DataFrame, orders: DataFrame, flag: str | None = None) -> DataFrame:
    """Items of known orders, without a-la-carte roots; with ``flag`` these stay, marked FALSE in that column."""
    rule = ("parent_order_item_id", "is_a_la_carte")
    if flag is not None:
        kept = items.withColumn(flag, F.coalesce(no_alacarte_root(*rule), F.lit(False)))
    else:
        kept = drop_alacarte_roots(items, *rule)
    return kept.join(orders, "order_id", "inner")


def attach_payment(df: DataFrame, payments: DataFrame, link: str = "id") -> DataFrame:
    """Left-join payments: ``id`` by the order's payment id, ``order`` by the payment's order id.

    Orders without payment id would all meet in the task of the NULL key. Their key is made of the order's id instead, with a
    mark in front that no payment's key has.
    """
    if link == "id":
        paid, alone = F.concat(F.lit("p"), F.col("payment_transaction_id")), F.concat(F.lit("o"), F.col("order_id"))
        left = df.withColumn("_pay_key", F.coalesce(paid, alone))
        right = payments.drop("order_id").withColumn("_pay_key", paid).drop("payment_transaction_id")
        return left.join(right, "_pay_key", "left").drop("_pay_key")
    if link == "order":
        return df.drop("payment_transaction_id").join(payments, "order_id", "left")
    raise ValueError(f"unknown payment link {link!r}")


def join_agg(df: DataFrame, agg: DataFrame, on: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Left-join a one-row-per-key aggregate and fill its gaps."""
    joined = df.join(agg, on, "left")
    fills = {n: F.coalesce(F.col(n), v) for n, v in (defaults or {}).items()}
    return joined.withColumns(fills) if fills else joined


def join_raw(df: DataFrame, refunds: DataFrame, on: str) -> DataFrame:
    """Left-join unaggregated refunds; a payment with several refunds repeats its lines."""
    return df.join(refunds, on, "left")


def join_first(df: DataFrame, ranked: DataFrame, on: str, rank_col: str = "rn") -> DataFrame:
    """Left-join only the first-ranked row of each key."""
    return df.join(ranked.filter(F.col(rank_col) == 1), on, "left")


def refund_lines(df: DataFrame, events: DataFrame, which: str = "all", on: str = "order_item_id") -> DataFrame:
    """Items with their refund events: ``all`` of them, or only the ``first`` (needs ``rn``)."""
    if which == "first":
        events = events.filter(F.col("rn") == 1)
    elif which != "all":
        raise ValueError(f"unknown choice {which!r}")
    return df.join(events, on, "inner")


def attach_history(df: DataFrame, history: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left-join order history by order; several rows repeat the order's lines unless ``dedupe``.

    ``dedupe`` keeps the latest row per order. ``history`` is in model names and has ``created_on_oh``
    and ``order_history_id``.
    """
    if dedupe:
        carried = [c for c in history.columns if c != "order_id"]
        latest = F.max_by(F.struct(*carried), F.struct("created_on_oh", "order_history_id"))
        history = history.groupBy("order_id").agg(latest.alias("_h")).select("order_id", "_h.*")
    return df.join(history, "order_id", "left")


def without(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys, on, "left_anti")


def within(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys, on, "left_semi")


def restrict(report: DataFrame, ids: DataFrame, label: str = "Order Id", id_col: str = "order_number") -> DataFrame:
    """Report rows of the listed order numbers; text that is no number matches nothing."""
    key = as_long(quoted(label), strict=False)
    return report.join(ids.select(F.col(id_col).alias("_expected")), key == F.col("_expected"), "inner").drop("_expected")


__all__ = [
    "attach_history",
    "attach_payment",
    "base_lines",
    "enrich",
    "join_agg",
    "join_first",
    "join_raw",
    "lines_from_items",
    "refund_lines",
    "restrict",
    "within",
    "without",
]
