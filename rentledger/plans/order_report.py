"""Order report: one row per order line item.

``variant`` selects a rule set; single rules can be changed with keyword arguments.

=============  ==================================================================================
``current``    the latest report
``staged``     its staged predecessor with dynamic columns
``static``     the first staged report, without dynamic columns
=============  ==================================================================================

``order_total`` and ``clamped``, the first generation, live in ``layered.py``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formulas import collected_order, final_subtotal, refund_ratio, total_fee
from ..functions.money import money, money_from_double, ratio, zero
from ..functions.scalar import actual_amount, blank, flag_text, mask_user, partner_text, refunded_flag, text
from ..functions.timefmt import DAY_FIRST, MONTH_FIRST, double_shift, local_date
from ..operators.aggregates import event_order
from ..operators.filters import positive
from ..operators.joins import join_agg, lines_from_items
from ..operators.projection import blank_nulls, label, move_column
from .layered import clamped_order_report, order_total_report
from .model import (
    ATTRIBUTE_COLUMNS,
    Attributes,
    Tables,
    attributes,
    coupons_of,
    items_of,
    model,
    of_part,
    order_header,
    widened,
    with_dimensions,
    written,
)
from .parts import in_parts, parts_of


@dataclass(frozen=True)
class OrderRules:
    payment_link: str = "id"  # payment of an order: "id" (order's payment id) or "order" (payment's order id)
    refunded: str = "sum"  # refunded amount of an item: "sum" of its events or the "first" one
    source_flag: bool = False  # "Refunded?" of items without refunds: the source flag instead of FALSE
    null_as_zero: bool = True  # unknown money: 0.00 instead of blank
    null_fee_as_zero: bool = True  # unknown create fee: 0.00 instead of blank
    round_fee_first: bool = True  # processor fee rounded to cents before proration
    round_refund_sums: bool = True
    blank_partner_zero: bool = True
    collected_as_text: bool = True
    date_format: str = DAY_FIRST
    live_only: bool = True  # dynamic columns: leave out soft-deleted attribute values
    capital_id: bool = True  # spelling of the ID labels


RULES = {
    "current": OrderRules(),
    "staged": OrderRules(
        payment_link="order",
        refunded="first",
        null_as_zero=False,
        round_fee_first=False,
        collected_as_text=False,
        live_only=False,
    ),
    "static": OrderRules(
        payment_link="order",
        source_flag=True,
        null_as_zero=False,
        null_fee_as_zero=False,
        round_fee_first=False,
        round_refund_sums=False,
        blank_partner_zero=False,
        collected_as_text=False,
        date_format=MONTH_FIRST,
        live_only=False,
        capital_id=False,
    ),
}

# Report labels in their order, with the column each one shows.
LABELS = [
    ("reservation_code", "RID"),
    ("order_number", "Order Id"),
    ("order_item_id", "Line Item ID"),
    ("order_date", "Order Date"),
    ("original_amount", "Original Order Amount"),
    ("order_refund", "Order Refunded Amount"),
    ("order_amount", "Order Amount"),
    ("payment_source", "Order Type"),
    ("payment_type", "Payment Method"),
    ("payment_provider_name", "Payment Processor"),
    ("refunded_flag", "Refunded?"),
    ("user", "User"),
    ("product_name", "Product Name"),
    ("rental_start", "Rental Start Date"),
    ("rental_end", "Rental End Date"),
    ("location_name", "Location"),
    ("site_name", "Subsite Location"),
    ("line_subtotal", "Line Item Sub Total"),
    ("coupon_code", "Promo Code ID"),
    ("coupon_amount", "Coupon Amount"),
    ("line_discount", "Line Item Discount"),
    ("gratuity", "Gratuity"),
    ("final_subtotal", "Final Line Item Sub Total"),
    ("line_booking_fee", "Booking Fee"),
    ("create_fee", "Create Line Item Payment Processor Fee"),
    ("refund_fee", "Refund Line Item Payment Processor Fee"),
    ("total_fee", "Total Line Item Payment Processor Fee"),
    ("tax_percent", "Tax %"),
    ("tax", "Tax"),
    ("line_delivery_fee", "Delivery Fee"),
    ("total_collected", "Total Collected"),
    ("partner_name", "Partner Name"),
    ("partner", "PartnerID"),
]
# Labels the static report spells differently.
STATIC_LABELS = {
    "Line Item ID": "Line Item Id",
    "Promo Code ID": "Promo Code Id",
    "Tax %": "Tax%",
    "PartnerID": "Partner Id",
}
# Place of the "Tax Counties" column among the dynamic report's columns.
TAX_COUNTIES, TAX_COUNTIES_ORDINAL = "Tax Counties", 18

_EVENT_COLUMNS = {
    "Id": "event_id",
    "OrderItemId": "order_item_id",
    "CreatedOn": "event_time",
    "RefundedTotalAmount": "event_amount",
    "TotalAmount": "amount_before",
}


def refund_summary(tables: Tables, refunded: str) -> DataFrame:
    """Refunded amount per item and the item's amount before its first refund."""
    events = positive(model(tables, "OrderItemsHistory", _EVENT_COLUMNS), "event_amount")
    first = event_order("event_time", "event_id")
    amount = F.sum("event_amount") if refunded == "sum" else F.min_by("event_amount", first)
    return events.groupBy("order_item_id").agg(
        amount.alias("refunded_amount"), F.min_by("amount_before", first).alias("amount_before")
    )


# Lines that the report shows; a-la-carte roots are carried along for the names of their attributes only.
SHOWN = "_shown"


def orders_known(tables: Tables, rules: OrderRules, attrs: Attributes | None = None) -> DataFrame:
    """What the report shows of each order."""
    header = order_header(tables, link=rules.payment_link, round_refund_sums=rules.round_refund_sums, attrs=attrs)
    return header.withColumns(_order_values(rules)).drop("order_total", "user_name")


def order_lines(tables: Tables, rules: OrderRules, attrs: Attributes | None = None, header: DataFrame | None = None) -> DataFrame:
    """Report lines in model names; dimensions come last, so the large joins carry ids only.

    What an order or an item shows by itself is worked out before they meet: an order's values once for all of its lines, and the
    generated method of the last join stays below the 8,000 bytes up to which the JVM compiles it. ``header`` are the orders known,
    where they are written already.
    """
    items = join_agg(items_of(tables, attrs), refund_summary(tables, rules.refunded), "order_item_id")
    items = join_agg(items, coupons_of(tables), "order_item_id").withColumns(_item_values(rules)).drop(*_ITEM_ONLY)
    header = orders_known(tables, rules, attrs) if header is None else header
    return with_dimensions(lines_from_items(items, header, SHOWN if attrs else None), tables, attrs=attrs)


_ITEM_ONLY = ["created_on", "start_date", "end_date", "total_items", "coupon_discount", "discount", "total_amount", "amount_before"]


def _known(col: Column, rules: OrderRules) -> Column:
    return zero(col) if rules.null_as_zero else col


def _order_values(rules: OrderRules) -> dict[str, Column]:
    """What depends on the order alone."""
    c = F.col
    return {
        "original_amount": text(_known(money(c("paid_amount")), rules)),
        "order_refund": text(money(zero(c("sum_total_refund_amount")))),
        "order_amount": text(_known(money(c("order_total")), rules)),
        "user": mask_user(c("payment_source"), c("user_name")),
    }


def _item_values(rules: OrderRules) -> dict[str, Column]:
    """What depends on the item alone."""
    c = F.col

    def known(col: Column) -> Column:
        return _known(col, rules)

    refunded = zero(c("refunded_amount"))
    flag = refunded_flag(refunded, c("is_refunded_source") if rules.source_flag else F.lit(False))
    return {
        "actual": known(actual_amount(refunded, c("amount_before"), c("total_amount"))),
        "line_subtotal": text(known(money(c("total_items")))),
        "coupon_amount": text(known(money(c("coupon_discount")))),
        "line_discount": text(known(money(c("discount")))),
        "final_subtotal": money(final_subtotal(known(c("total_items")), known(c("coupon_discount")), known(c("discount")))),
        "order_date": local_date(c("created_on"), fmt=rules.date_format),
        "refunded_flag": flag_text(flag),
        "partner": partner_text(c("partner_id")) if rules.blank_partner_zero else text(c("partner_id")),
        "rental_start": double_shift(c("start_date"), fmt=rules.date_format),
        "rental_end": double_shift(c("end_date"), fmt=rules.date_format),
    }


def _report_steps(rules: OrderRules) -> list[dict[str, Column]]:
    """Columns to add, step by step.

    A value that later ones use several times gets a step of its own, so that it is computed once.
    """
    c = F.col

    def known(col: Column) -> Column:
        return _known(col, rules)

    def cents(name: str) -> Column:
        return known(money(c(name)))

    refunded = zero(c("refunded_amount"))
    fee = cents("processing_fee") if rules.round_fee_first else c("processing_fee")
    total_refund = c("sum_total_refund_amount")
    refunded_fee = zero(c("sum_refunded_processing_fee"))
    shown = {
        "_create": ratio(fee, c("actual"), c("paid_amount")),
        "_back": refund_ratio(refunded_fee, refunded, total_refund),
        "gratuity": cents("tip"),
        "line_booking_fee": cents("booking_fee"),
        "tax_percent": cents("tax_percentage"),
        "tax": cents("sales_tax"),
        "line_delivery_fee": cents("delivery_fee"),
    }
    create, back = money_from_double(c("_create")), money_from_double(c("_back"))
    fees = {
        "create_fee": zero(create) if rules.null_fee_as_zero else create,
        "refund_fee": zero(back) if rules.null_as_zero else back,
    }
    parts = ["gratuity", "final_subtotal", "line_booking_fee", "tax", "line_delivery_fee", "create_fee", "refund_fee"]
    totals = {
        "total_fee": total_fee(c("create_fee"), c("refund_fee")),
        "total_collected": collected_order(*[c(p) for p in parts]),
    }
    return [shown, fees, totals]


def _labelled(tables: Tables, rules: OrderRules, attrs: Attributes | None = None, header: DataFrame | None = None) -> DataFrame:
    """Labelled report; with ``attrs`` the attribute columns and the flag of shown lines stand behind it."""
    lines = order_lines(tables, rules, attrs, header)
    for step in _report_steps(rules):
        lines = lines.withColumns(step)
    pairs: list[tuple[str | Column, str]] = []
    for name, shown in LABELS:
        keep_type = name == "total_collected" and not rules.collected_as_text
        shown = shown if rules.capital_id else STATIC_LABELS.get(shown, shown)
        pairs.append((F.col(name) if keep_type else blank(text(F.col(name))), shown))
    if attrs is None:
        return label(lines, [*pairs, (F.col("order_id"), "order_id_original")])
    return label(lines, [*pairs, *[(F.col(c), c) for c in (*ATTRIBUTE_COLUMNS.values(), SHOWN)]])


def order_report(
    tables: Tables,
    variant: str = "current",
    dynamic: bool = False,
    control_columns: dict[str, list[str]] | None = None,
    stage: str | None = None,
    parts: int | None = None,
    **rules,
) -> DataFrame:
    """Order report; see the module text for ``variant`` and ``OrderRules`` for ``rules``.

    ``dynamic`` adds one column per exported control and makes every column text. The report is written once, to ``stage``
    or below ``spark.checkpoint.dir``, and the names of these columns are read from what was written, unless
    ``control_columns`` lists them per scope: ``order``, ``product``, ``location``.

    Above 16,000,000 items the report is written in parts, see ``parts.py``; ``parts`` gives their number.
    """
    if variant in ("order_total", "clamped") and (dynamic or control_columns or rules):
        raise TypeError(f"the {variant} report has no dynamic columns and takes no rules")
    if variant == "order_total":
        return order_total_report(tables, parts=parts)
    if variant == "clamped":
        return clamped_order_report(tables, parts=parts)
    chosen = replace(RULES[variant], **rules)
    attrs = attributes(tables, chosen.live_only) if dynamic else None
    if dynamic and control_columns is None:
        attrs = written(attrs, tables, stage)
    parts = parts_of(tables, dynamic) if parts is None else parts
    if parts == 1:
        report = _labelled(tables, chosen, attrs)
    else:
        header = orders_known(tables, chosen, attrs)
        report = in_parts(tables, parts, header, lambda part, known: _labelled(part, chosen, of_part(attrs, part, chosen.live_only), known), stage)
    if not dynamic:
        return report
    wide = widened(report, tables, control_columns, stage, shown=SHOWN, is_written=parts > 1)
    return blank_nulls(move_column(wide, TAX_COUNTIES, TAX_COUNTIES_ORDINAL))
