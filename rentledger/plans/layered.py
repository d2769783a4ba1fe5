"""First-generation reports: a clean layer in model names, double-precision formulas, nothing rounded.

Payments join by order and refunds are not summed up, so an order with several payments, refunds or
history rows repeats its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formulas import (
    booking_share,
    collected_level,
    collected_share,
    fees_by_order_total,
    final_subtotal,
)
from ..functions.scalar import default, first_non_null, full_name
from ..operators.aggregates import coupon_codes
from ..operators.controls import apart
from ..operators.joins import base_lines, enrich, join_agg, join_raw, without
from ..operators.projection import label, rename_project
from .parts import in_parts, parts_of

# Model names of the clean layer.
CLEAN_COLUMNS = {
    "Orders": {
        "Id": "order_id",
        "ReservationId": "reservation_id",
        "PaymentTransactionId": "payment_transaction_id",
        "CreatedBy": "created_by",
        "BookingFee": "booking_fee",
        "DeliveryFee": "order_delivery_fee",
        "Total": "total",
        "OrderNumber": "order_number",
    },
    "OrderItems": {
        "Id": "order_item_id",
        "OrderId": "order_id",
        "ProductId": "product_id",
        "LocationId": "location_id",
        "SiteId": "site_id",
        "RentalTypeId": "rental_type_id",
        "CouponDiscount": "coupon_discount",
        "Tip": "tip",
        "Discount": "discount",
        "SalesTax": "sales_tax",
        "DeliveryFee": "item_delivery_fee",
        "TotalAmount": "total_amount_items",
        "Total": "total_items",
        "CreatedOn": "created_on_items",
        "IsRefunded": "is_refunded",
        "StartDate": "start_date",
        "EndDate": "end_date",
        "PartnerId": "partner_id",
    },
    "OrderHistory": {
        "OrderId": "order_id",
        "RefundedTotal": "order_level_refund",
        "RefundOrderNumber": "refund_order_number",
    },
    "PaymentTransactions": {
        "Id": "payment_id",
        "OrderId": "order_id",
        "Amount": "paid_amount",
        "ProcessingFee": "processing_fee",
        "Source": "order_type",
        "PaymentType": "payment_type",
        "PaymentProviderName": "payment_provider_name",
    },
    "PaymentRefund": {"PaymentTransactionId": "payment_id", "RefundedProcessingFee": "refunded_processing_fee"},
}


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal amounts in double precision, the type these reports compute in."""
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({n: F.col(n).cast("double") for n in found}) if found else df


def clean_layer(tables: dict[str, DataFrame], fan_out: bool = True) -> dict[str, DataFrame]:
    """The transactional tables under model names.

    Without ``fan_out`` history is summed per order, with the list of its refund order numbers, and refunded fees per payment.
    """
    named = {name: rename_project(tables[name], columns) for name, columns in CLEAN_COLUMNS.items()}
    if not fan_out:
        refunds = F.sum("order_level_refund").alias("order_level_refund")
        # Summed per number first, so that what is gathered of an order is its distinct numbers.
        by_number = named["OrderHistory"].groupBy("order_id", "refund_order_number").agg(refunds)
        numbers = F.transform(F.array_sort(F.collect_list("refund_order_number")), lambda n: n.cast("string"))
        named["OrderHistory"] = by_number.groupBy("order_id").agg(refunds, F.when(F.size(numbers) > 0, F.array_join(numbers, ", ")).alias("refund_order_number"))
        fees = F.sum("refunded_processing_fee").alias("refunded_processing_fee")
        named["PaymentRefund"] = named["PaymentRefund"].groupBy("payment_id").agg(fees)
    return {name: as_doubles(df) for name, df in named.items()}


def orders_known(tables: dict[str, DataFrame], provider_default: str | None = None, fan_out: bool = False) -> DataFrame:
    """Orders with history, payments, refunds and user: what is known per order meets the orders before the items do."""
    clean = clean_layer(tables, fan_out)
    orders = clean["Orders"].join(clean["OrderHistory"], "order_id", "left")
    paid = join_raw(clean["PaymentTransactions"], clean["PaymentRefund"], "payment_id")
    orders = orders.join(paid, "order_id", "left")
    if provider_default is not None:
        provider = default(F.col("payment_provider_name"), provider_default)
        orders = orders.withColumn("payment_provider_name", provider)
    names = {"user_name": full_name(F.col("FirstName"), F.col("LastName"))}
    return enrich(orders, tables["Users"], "created_by", "Id", names)


def lines(tables: dict[str, DataFrame], provider_default: str | None = None, fan_out: bool = False) -> DataFrame:
    """Order lines with dimensions, payments, refunds and coupons: one row per item and payment of its order.

    ``fan_out`` repeats a line for every history row of the order and every refund of the payment, as the first
    reports did: an order with k refunds then has k rows for each of its items.
    """
    return _lines(tables, apart(orders_known(tables, provider_default, fan_out)))


def _lines(tables: dict[str, DataFrame], orders: DataFrame, items_only: bool = False) -> DataFrame:
    """Lines of ``orders``; with ``items_only`` orders without an item have none."""
    locations = as_doubles(tables["Locations"])
    items = as_doubles(rename_project(tables["OrderItems"], CLEAN_COLUMNS["OrderItems"]))
    # The large dimension meets the items before these meet the orders.
    items = enrich(items, tables["Products"], "product_id", "Id", {"product_name": "Name"})
    items = items.join(coupon_codes(tables["OrderCoupons"], tables["Coupons"]), "order_item_id", "left")
    if items_only:
        items = items.withColumn("_item", F.lit(True))
    out = base_lines(orders, tables["Reservations"], items)
    if items_only:
        out = out.where("_item").drop("_item")
    out = enrich(out, locations, "location_id", "Id", {"location_name": "Name", "location_tax": "TaxRate"})
    out = enrich(out, locations, "site_id", "Id", {"site_name": "Name", "site_tax": "TaxRate"})
    out = enrich(out, tables["Partners"], "partner_id", "Id", {"partner_name": "Name"})
    return out.withColumn("tax_percentage", first_non_null(F.col("site_tax"), F.col("location_tax")))


def _report_lines(tables: dict[str, DataFrame], provider_default: str | None = None, fan_out: bool = False, parts: int | None = None) -> DataFrame:
    """Lines, in parts above 16,000,000 items, see ``parts.py``. Orders without an item are a part of their own.

    Lines that are written have no keys but those that reports show; figures, which compress badly, are worked out behind.
    """
    parts = parts_of(tables) if parts is None else parts
    if parts == 1:
        return lines(tables, provider_default, fan_out)

    def rest(known: DataFrame) -> DataFrame:
        alone = without(known, tables["OrderItems"].select(F.col("OrderId").alias("order_id")), ["order_id"])
        none = {"OrderItems": tables["OrderItems"].where(F.lit(False))}
        return _lines({n: none.get(n, tables[n]) for n in _LINE_TABLES}, alone).drop(*_KEYS)

    orders = orders_known(tables, provider_default, fan_out)
    return in_parts(tables, parts, orders, lambda part, known: _lines(part, known, items_only=True).drop(*_KEYS), rest=rest)


_KEYS = ["order_id", "reservation_id", "payment_transaction_id", "payment_id", "created_by", "product_id", "location_id", "site_id", "rental_type_id"]
_LINE_TABLES = ["OrderItems", "Products", "OrderCoupons", "Coupons", "Reservations", "Locations", "Partners"]


# Report labels in their order, with the column each one shows.
ORDER_LABELS = [
    ("reservation_code", "RID"),
    ("order_number", "Order Id"),
    ("order_item_id", "Line Item Id"),
    ("created_on_items", "Order Date"),
    ("paid_amount", "Original Order Amount"),
    ("order_level_refund", "Order Refunded Amount"),
    ("total", "Order Amount"),
    ("order_type", "OrderType"),
    ("payment_type", "Payment Method"),
    ("payment_provider_name", "Payment Processer"),
    ("is_refunded", "Refunded?"),
    ("user_name", "User"),
    ("product_name", "Product Name"),
    ("start_date", "Rental Start Date"),
    ("end_date", "Rental End Date"),
    ("location_name", "Location"),
    ("site_name", "Substitue Location"),
    ("line_subtotal", "Line Item Sub Total"),
    ("coupon_code", "Promo Code Id"),
    ("coupon_discount", "Coupon Amount"),
    ("discount", "Line Item Discount"),
    ("tip", "Gratuity"),
    ("final_subtotal", "Final Line Item Sub Total"),
    ("line_booking_fee", "Booking Fee"),
    ("create_fee", "Create Line Item Payment Processor Fee"),
    ("refund_fee", "Refund Line Item Payment Processor Fee"),
    ("total_fee", "Total Line Item Payment Processor Fee"),
    ("tax_percentage", "Tax%"),
    ("sales_tax", "Tax"),
    ("line_delivery_fee", "Delivery Fee"),
    ("total_collected", "Total Collected"),
    ("partner_name", "Parner Name"),
    ("partner_id", "PartnerId"),
]
REFUND_LABELS = [
    ("reservation_code", "RID"),
    ("order_number", "OrderId"),
    ("order_item_id", "LineItemId"),
    ("created_on_items", "OriginalOrderDate"),
    ("total_amount_items", "OriginalLineItemAmount"),
    ("order_type", "OrderType"),
    ("refund_amount", "RefundAmount"),
    ("payment_type", "PaymentMethod"),
    ("payment_provider_name", "PaymentProcessor"),
    ("refund_order_number", "RefundOrderId"),
    ("user_name", "User"),
    ("product_name", "ProductName"),
    ("start_date", "RentalStartDate"),
    ("end_date", "RentalEndDate"),
    ("location_name", "LocationName"),
    ("site_name", "SubsiteLocationName"),
    ("tax_percentage", "TaxPercent"),
    ("total_amount_items", "LineItemSubTotal"),
    ("coupon_code", "PromoCodeId"),
    ("coupon_discount", "CouponAmount"),
    ("discount", "LineItemDiscount"),
    ("tip", "Gratuity"),
    ("final_subtotal", "FinalLineItemSubTotal"),
    ("booking_fee", "BookingFee"),
    ("processing_fee", "ProcessingFees"),
    ("sales_tax", "Tax"),
    ("item_delivery_fee", "DeliveryFee"),
    ("total_collected", "TotalCollected"),
    ("partner_name", "PartnerName"),
    ("partner_id", "PartnerId"),
]


def _cols(*names: str) -> list[Column]:
    return [F.col(n) for n in names]


def order_total_report(tables: dict[str, DataFrame], fan_out: bool = False, parts: int | None = None) -> DataFrame:
    """Fees prorated by the item's part of the order total."""
    fees = fees_by_order_total(*_cols("processing_fee", "refunded_processing_fee", "total_amount_items", "total"))
    figures = {
        "line_subtotal": F.col("total_items"),
        "final_subtotal": final_subtotal(*_cols("total_amount_items", "coupon_discount", "discount")),
        "line_booking_fee": F.col("booking_fee"),
        "create_fee": fees[0],
        "refund_fee": fees[1],
        "total_fee": fees[2],
        "line_delivery_fee": F.col("order_delivery_fee"),
        "total_collected": collected_level(*_cols("paid_amount", "order_level_refund", "refunded_processing_fee")),
    }
    return label(_report_lines(tables, None, fan_out, parts).withColumns(figures), list(ORDER_LABELS))


def clamped_order_report(tables: dict[str, DataFrame], fan_out: bool = False, parts: int | None = None) -> DataFrame:
    """Missing amounts count as 0, the subtotal is not negative, booking fee and total are prorated."""
    nil = F.lit(0.0)
    amount, total = _cols("total_amount_items", "total")
    fee, back = (F.coalesce(c, nil) for c in _cols("processing_fee", "refunded_processing_fee"))
    known = [F.coalesce(c, nil) for c in _cols("total_amount_items", "coupon_discount", "discount")]
    collected = collected_share(
        *_cols("paid_amount", "order_level_refund", "refunded_processing_fee"), amount, total
    )
    figures = {
        "line_subtotal": amount,
        "final_subtotal": final_subtotal(*known, floor=0.0),
        "line_booking_fee": booking_share(F.col("booking_fee"), amount, total),
        "create_fee": fee * amount / F.nullif(total, nil),
        "refund_fee": back * amount / F.nullif(total, nil),
        "total_fee": (fee + back) * amount / F.nullif(total, nil),
        "line_delivery_fee": F.col("item_delivery_fee"),
        "total_collected": collected,
        "tax_percentage": F.round(F.col("tax_percentage").cast("decimal(20,6)"), 2).cast("decimal(20,2)"),
    }
    return label(_report_lines(tables, "Unknown", fan_out, parts).withColumns(figures), list(ORDER_LABELS))


def refund_report(tables: dict[str, DataFrame], fan_out: bool = False) -> DataFrame:
    """Order-level refunds on every line of the order, with the payment they were paid by.

    With ``fan_out`` the order's payments, refunds and history rows meet the lines a second time, as in the first report, so
    their number enters the row count squared.
    """
    rows = lines(tables, fan_out=fan_out)
    if fan_out:
        clean = clean_layer(tables)
        again = join_raw(clean["PaymentTransactions"], clean["PaymentRefund"], "payment_id")
        again = again.select("order_id", "order_type", "payment_type", "payment_provider_name", "refunded_processing_fee")
        rows = rows.drop(*again.columns[1:], "order_level_refund", "refund_order_number")
        rows = rows.join(clean["OrderHistory"], "order_id", "left").join(again, "order_id", "left")
    rows = rows.withColumn("refund_amount", F.col("order_level_refund")).withColumns(
        {
            "tax_percentage": F.round(F.col("tax_percentage").cast("decimal(20,6)"), 2).cast("decimal(20,2)"),
            "final_subtotal": final_subtotal(*_cols("total_amount_items", "coupon_discount", "discount")),
            "total_collected": collected_level(*_cols("paid_amount", "refund_amount", "refunded_processing_fee")),
        }
    )
    return label(rows, list(REFUND_LABELS))


def payments_view(tables: dict[str, DataFrame], repeat_refunds: bool = False) -> DataFrame:
    """Payment, location and site of every item; not stored. One row per item and payment of its order.

    ``refund_count`` says how many refunds the payment has. The first view joined the refunds and so repeated a row for each of them
    without showing which; ``repeat_refunds`` does that, from the count alone, and leaves the count out.
    """
    clean = clean_layer(tables)
    locations = as_doubles(tables["Locations"])
    counts = tables["PaymentRefund"].groupBy(F.col("PaymentTransactionId").alias("payment_id")).agg(F.count(F.lit(1)).alias("refund_count"))
    paid = join_agg(clean["PaymentTransactions"], counts, "payment_id", {"refund_count": F.lit(0)})
    out = clean["Orders"].drop("payment_transaction_id").join(clean["OrderItems"], "order_id", "left")
    out = out.join(paid.withColumnRenamed("payment_id", "payment_transaction_id"), "order_id", "left")
    out = enrich(out, locations, "location_id", "Id", {"location_name": "Name", "tax_rate": "TaxRate"})
    out = enrich(out, locations, "site_id", "Id", {"site_name": "Name", "site_tax_rate": "TaxRate"})
    view = out.select(
        "order_id",
        "order_item_id",
        "payment_transaction_id",
        "paid_amount",
        "processing_fee",
        "total",
        "sales_tax",
        "booking_fee",
        F.col("order_delivery_fee").alias("delivery_fee"),
        "payment_type",
        "payment_provider_name",
        "location_name",
        "tax_rate",
        "site_name",
        "site_tax_rate",
        "refund_count",
    )
    if not repeat_refunds:
        return view
    times = F.greatest(F.coalesce("refund_count", F.lit(1)), F.lit(1)).cast("int")
    return view.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy", "refund_count")
