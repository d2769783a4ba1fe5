"""The queries of ``queries.py`` as SQL for DuckDB, written from the report definitions."""

from __future__ import annotations

import re

from rentledger.sources.schema import SNAPSHOT_COLUMNS

from .model_sql import MODEL, with_model

MONEY = "decimal(20,2)"
# The orders that the subset queries are asked for, by a rule on the orders table.
IDS = "(SELECT OrderNumber AS order_number FROM m_Orders WHERE OrderNumber % 7 = 3)"
LISTED = "(SELECT unnest(range(500000000000, 500000000600, 7)) AS order_number)"


def m2(x: str) -> str:
    return f"cast(round({x}, 2) as {MONEY})"


def z(x: str) -> str:
    return f"coalesce({x}, 0)"


def units(x: str, scale: int) -> str:
    return f"cast(({x}) * {10**scale} as hugeint)"


def from_cents(x: str) -> str:
    return f"cast(cast({x} as decimal(20,0)) * 0.01 as {MONEY})"


def share(a: str, b: str, c: str) -> str:
    """a * b / c to cents in whole numbers, half up; a has four decimals, b and c two; none is negative."""
    num, den = f"2 * {units(a, 4)} * {units(b, 2)} + 100 * {units(c, 2)}", f"200 * {units(c, 2)}"
    return f"CASE WHEN ({c}) <> 0 THEN {from_cents(f'({num}) // ({den})')} END"


def day(ts: str, zone: str = "America/Chicago", fmt: str = "%d/%m/%Y") -> str:
    return f"strftime(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{zone}', '{fmt}')"


def reread(ts: str, session: str = "America/Chicago", fmt: str = "%d/%m/%Y", via: str = "Asia/Kolkata") -> str:
    wall = f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE '{via}')"
    return f"strftime(({wall} AT TIME ZONE 'America/Chicago') AT TIME ZONE '{session}', '{fmt}')"


US, CLOCK = "%m/%d/%Y", "%I:%M:%S %p"

# Items with the figures of their order, as used by the formula queries.
REFUND_SUMS = """refund_sums AS (
  SELECT PaymentTransactionId, sum(Amount) AS total_refund, sum(RefundedProcessingFee) AS refunded_fee
  FROM m_PaymentRefund GROUP BY PaymentTransactionId)"""
ITEM_REFUNDS = """item_refunds AS (
  SELECT OrderItemId, sum(RefundedTotalAmount) AS refunded FROM m_OrderItemsHistory
  WHERE RefundedTotalAmount > 0 GROUP BY OrderItemId)"""
FIRST_EVENTS = """ranked_events AS (
  SELECT *, row_number() OVER (PARTITION BY OrderItemId ORDER BY CreatedOn NULLS LAST, Id) AS rn
  FROM m_OrderItemsHistory WHERE RefundedTotalAmount > 0),
first_events AS (SELECT * FROM ranked_events WHERE rn = 1)"""
COUPONS = """coupon_lists AS (
  SELECT oc.OrderItemId, string_agg(cp.CouponCode, ',' ORDER BY cp.CouponCode) AS coupon_code
  FROM m_OrderCoupons oc JOIN m_Coupons cp ON cp.Id = oc.CouponId GROUP BY oc.OrderItemId)"""
NO_ROOTS = "NOT (oi.ParentOrderItemId IS NULL AND oi.IsALaCarte = true)"
LINES = f"""{REFUND_SUMS},
{ITEM_REFUNDS},
lines AS (
  SELECT oi.*, o.Id AS oid, pt.ProcessingFee, pt.Amount AS paid, ir.refunded, rs.total_refund, rs.refunded_fee
  FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId
  LEFT JOIN m_PaymentTransactions pt ON pt.Id = o.PaymentTransactionId
  LEFT JOIN refund_sums rs ON rs.PaymentTransactionId = pt.Id
  LEFT JOIN item_refunds ir ON ir.OrderItemId = oi.Id
  WHERE {NO_ROOTS})"""
CREATE = share("ProcessingFee", "TotalAmount", "paid")
BACK = f"CASE WHEN {z('refunded_fee')} = 0 OR {z('refunded')} = 0 THEN 0 ELSE {share(z('refunded_fee'), z('refunded'), 'total_refund')} END"
PARTS = "Tip + Total + BookingFee + SalesTax + DeliveryFee"
NAME = "concat(coalesce(u.FirstName, ''), ' ', coalesce(u.LastName, ''))"


def of_items(expr: str) -> str:
    return f"SELECT Id AS order_item_id, {expr} AS result FROM m_OrderItems"


def of_lines(expr: str, out: str = "result") -> str:
    return f"WITH {LINES} SELECT Id AS order_item_id, {expr} AS {out} FROM lines"


EVENT_LINES = f"""{LINES},
event_lines AS (
  SELECT l.*, h.Id AS event_id, h.RefundedTotalAmount AS e_amount, h.RefundedTotal AS e_total, h.RefundedCouponDiscount AS e_coupon,
         h.RefundedDiscount AS e_discount, h.RefundedTip AS e_tip, h.RefundedBookingFee AS e_booking,
         h.RefundedSalesTax AS e_tax, h.RefundedDeliveryFee AS e_delivery
  FROM lines l JOIN m_OrderItemsHistory h ON h.OrderItemId = l.Id WHERE h.RefundedTotalAmount > 0)"""


def refund_total(fee: str, amount: str, total: str, parts: str) -> str:
    """parts + fee * amount / total to cents, half away from zero; without a total the fee is 0."""
    c = units(total, 2)
    num = f"({units(parts, 2)} * 100 * {c} + {units(fee, 4)} * {units(amount, 2)})"
    with_fee = from_cents(f"sign({num}) * ((2 * abs({num}) + 100 * {c}) // (200 * {c}))")
    return f"coalesce(CASE WHEN {z(total)} <> 0 THEN {with_fee} ELSE {m2(parts)} END, 0)"


E_PARTS = f"{z('-e_tip')} - (e_total - e_coupon - e_discount) + {z('-e_booking')} + {z('-e_tax')} + {z('e_delivery')}"
SIGNED_FEE = f"-({share(z('refunded_fee'), 'e_amount', z('total_refund'))})"

# --- dynamic columns

def options_of(scope: str) -> str:
    """Options whose control is exported, with name and value: the relation that all attribute rows point to."""
    s = scope.capitalize()
    return f"""{scope}_options AS (
  SELECT op.Id AS option_id, dc.DisplayName AS control_name, op.Option AS control_value
  FROM m_{s}DynamicControlOptions op JOIN m_{s}DynamicControls dc ON dc.Id = op.DynamicControlId AND dc.ShowInExport)"""


def order_attrs(name: str) -> str:
    return f"""{options_of("order")},
order_attrs AS (
  SELECT OrderId AS order_id, {name} AS control_name, control_value
  FROM order_options JOIN m_OrderDynamicControlValues ON DynamicControlOptionId = option_id)"""


ORDER_ATTRS = order_attrs("""replace(control_name, '"', '')""")


def scope_attrs(scope: str, code: int, live: bool = True) -> str:
    """Own rows of items, rows of their product or location, and what holds: items without own rows inherit."""
    s, kept = scope.capitalize(), "WHERE IsDeleted = false" if live else ""
    return f"""{options_of(scope)},
{scope}_entity AS (
  SELECT {s}Id AS entity, control_name, control_value
  FROM m_{s}DynamicControlValues JOIN {scope}_options ON option_id = DynamicControlOptionId {kept}),
{scope}_all AS (
  SELECT Id AS order_item_id, control_name, control_value FROM m_OrderItems JOIN {scope}_entity ON entity = {s}Id),
{scope}_own AS (
  SELECT OrderItemId AS order_item_id, control_name, control_value
  FROM (SELECT * FROM m_OrderItemDynamicControls WHERE DynamicControlType = {code}) JOIN {scope}_options ON option_id = DynamicControlOptionId
  WHERE OrderItemId IN (SELECT Id FROM m_OrderItems)),
{scope}_attrs AS (
  SELECT * FROM {scope}_all ANTI JOIN {scope}_own USING (order_item_id)
  UNION ALL SELECT * FROM {scope}_own)"""


COLUMNS = {"order": ["Order Priority", "Order Status"], "product": ["Product Type", "Size Class"], "location": ["Tax Counties", "Zone %, A"]}


def pivot(scope: str, key: str) -> str:
    cols = ",\n    ".join(
        f"""string_agg(control_value, ', ' ORDER BY control_value) FILTER (WHERE control_name = '{n}') AS "{n}\""""
        for n in COLUMNS[scope]
    )
    return f"{scope}_pivot AS (SELECT {key}, {cols} FROM {scope}_attrs GROUP BY {key})"


def all_pivots(live: bool = True) -> str:
    return ",\n".join(
        [
            ORDER_ATTRS,
            pivot("order", "order_id"),
            scope_attrs("product", 0, live),
            pivot("product", "order_item_id"),
            scope_attrs("location", 1, live),
            pivot("location", "order_item_id"),
        ]
    )


DYNAMIC = [n for names in COLUMNS.values() for n in names]

# --- order report

DIMENSIONS = """LEFT JOIN m_Products p ON p.Id = oi.ProductId
  LEFT JOIN m_Locations l ON l.Id = oi.LocationId
  LEFT JOIN m_Locations site ON site.Id = oi.SiteId
  LEFT JOIN m_Users u ON u.Id = o.CreatedBy
  LEFT JOIN m_Partners pa ON pa.Id = oi.PartnerId"""


def order_sql(variant: str) -> str:
    """CTEs up to ``report``: the labelled columns plus order and item keys."""
    current, static = variant == "current", variant == "static"
    nz = z if current else (lambda x: x)
    fmt = US if static else "%d/%m/%Y"
    link = "pt.Id = o.PaymentTransactionId" if current else "pt.OrderId = o.Id"
    sums = REFUND_SUMS if static else REFUND_SUMS.replace("sum(Amount)", m2("sum(Amount)")).replace("sum(RefundedProcessingFee)", m2("sum(RefundedProcessingFee)"))
    refunded = "fe.RefundedTotalAmount" if variant == "staged" else "ir.refunded"
    fee = m2(z("ProcessingFee")) if current else "ProcessingFee"
    actual = nz("CASE WHEN refunded > 0 THEN before_amount ELSE TotalAmount END")
    create = share(fee, actual, "paid")
    create = create if static else z(create)
    back = f"CASE WHEN {z('refunded_fee')} = 0 OR refunded = 0 THEN 0 ELSE {share(z('refunded_fee'), 'refunded', 'total_refund')} END"
    back = z(back) if current else back
    flag = "IsRefunded" if static else "false"
    partner = f"cast(PartnerId as varchar)" if static else "CASE WHEN PartnerId = 0 THEN '' ELSE cast(PartnerId as varchar) END"

    def text(x: str) -> str:
        return f"coalesce(cast({x} as varchar), '')"

    def cents(x: str) -> str:
        return m2(nz(x))

    net = f"{nz('Total')} - {nz('CouponDiscount')} - {nz('Discount')}"
    collected = f"{cents('Tip')} + {m2(net)} + {cents('BookingFee')} + {cents('SalesTax')} + {cents('DeliveryFee')} - (create_fee - back_fee)"
    total = z(m2(collected))
    shown = [
        ("RID", text("ReservationCode")),
        ("Order Id", text("OrderNumber")),
        ("Line Item Id" if static else "Line Item ID", text("Id")),
        ("Order Date", text(day("CreatedOn", fmt=fmt))),
        ("Original Order Amount", text(cents("paid"))),
        ("Order Refunded Amount", text(m2(z("total_refund")))),
        ("Order Amount", text(cents("order_total"))),
        ("Order Type", text("Source")),
        ("Payment Method", text("PaymentType")),
        ("Payment Processor", text("PaymentProviderName")),
        ("Refunded?", f"upper({text(f'CASE WHEN refunded > 0 THEN true ELSE {flag} END')})"),
        ("User", "CASE WHEN Source = 'Consumer Web' THEN '' ELSE user_name END"),
        ("Product Name", text("product_name")),
        ("Rental Start Date", text(reread("StartDate", fmt=fmt))),
        ("Rental End Date", text(reread("EndDate", fmt=fmt))),
        ("Location", text("location_name")),
        ("Subsite Location", text("site_name")),
        ("Line Item Sub Total", text(cents("Total"))),
        ("Promo Code Id" if static else "Promo Code ID", text("coupon_code")),
        ("Coupon Amount", text(cents("CouponDiscount"))),
        ("Line Item Discount", text(cents("Discount"))),
        ("Gratuity", text(cents("Tip"))),
        ("Final Line Item Sub Total", text(m2(net))),
        ("Booking Fee", text(cents("BookingFee"))),
        ("Create Line Item Payment Processor Fee", text("create_fee")),
        ("Refund Line Item Payment Processor Fee", text("back_fee")),
        ("Total Line Item Payment Processor Fee", text(m2("create_fee - back_fee"))),
        ("Tax%" if static else "Tax %", text(cents("tax_rate"))),
        ("Tax", text(cents("SalesTax"))),
        ("Delivery Fee", text(cents("DeliveryFee"))),
        ("Total Collected", text(f"cast({total} as {MONEY})") if current else f"cast({total} as {MONEY})"),
        ("Partner Name", text("partner_name")),
        ("Partner Id" if static else "PartnerID", f"coalesce({partner}, '')"),
        ("order_id_original", "OrderId"),
    ]
    labels = ",\n  ".join(f'{e} AS "{n}"' for n, e in shown)
    return f"""{sums},
{ITEM_REFUNDS},
{FIRST_EVENTS},
{COUPONS},
base AS (
  SELECT oi.*, o.OrderNumber, o.Total AS order_total, r.ReservationCode, pt.Amount AS paid, pt.ProcessingFee, pt.Source,
         pt.PaymentType, pt.PaymentProviderName, rs.total_refund, rs.refunded_fee, coalesce({refunded}, 0) AS refunded,
         fe.TotalAmount AS before_amount, cl.coupon_code, p.Name AS product_name, l.Name AS location_name,
         site.Name AS site_name, {NAME} AS user_name, pa.Name AS partner_name, coalesce(site.TaxRate, l.TaxRate) AS tax_rate
  FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId
  LEFT JOIN m_Reservations r ON r.Id = o.ReservationId
  LEFT JOIN m_PaymentTransactions pt ON {link}
  LEFT JOIN refund_sums rs ON rs.PaymentTransactionId = pt.Id
  LEFT JOIN item_refunds ir ON ir.OrderItemId = oi.Id
  LEFT JOIN first_events fe ON fe.OrderItemId = oi.Id
  LEFT JOIN coupon_lists cl ON cl.OrderItemId = oi.Id
  {DIMENSIONS}
  WHERE {NO_ROOTS}),
priced AS (SELECT *, cast({create} as {MONEY}) AS create_fee, cast({back} as {MONEY}) AS back_fee FROM base),
report AS (SELECT
  {labels},
  Id AS item_key FROM priced)"""


# --- transaction report


def transaction_current_sql() -> str:
    actual = "CASE WHEN refunded > 0 THEN f_amount ELSE TotalAmount END"

    def pick(now: str, before: str) -> str:
        return f"CASE WHEN refunded = 0 THEN {now} ELSE {before} END"

    net = "line_total - coupon - disc"
    create = z(share("ProcessingFee", "actual", "paid"))
    e_net = "(h.RefundedTotal - h.RefundedCouponDiscount - h.RefundedDiscount)"
    e_parts = f"{z('-h.RefundedTip')} - {e_net} + {z('-h.RefundedBookingFee')} + {z('-h.RefundedSalesTax')} + {z('h.RefundedDeliveryFee')}"
    user = "CASE WHEN Source = 'Consumer Web' THEN '' ELSE coalesce(user_name, '') END"
    partner = "CASE WHEN PartnerId = 0 THEN '' ELSE coalesce(cast(PartnerId as varchar), '') END"
    same = f"""Id, OrderId, ReservationCode, OrderNumber, {day('CreatedOn')} AS original_date, Source, PaymentType, PaymentProviderName,
         {user} AS user_shown, product_name, rental_type, {reread('StartDate')} AS start_day, {reread('EndDate')} AS end_day,
         location_name, site_name, coupon_code, {m2('tax_rate')} AS tax_pct, partner_name, {partner} AS partner"""
    shown = [
        ("RID", "coalesce(ReservationCode, '')"),
        ("Order Id", "coalesce(cast(OrderNumber as varchar), '')"),
        ("Line Item ID", "coalesce(Id, '')"),
        ("Original Order Date", "coalesce(original_date, '')"),
        ("Transaction Date", "coalesce(t_date, '')"),
        ("Time Stamp", "coalesce(t_time, '')"),
        ("Original Line Item Amount", z(m2("amount"))),
        ("Order Type", "coalesce(Source, '')"),
        ("Transaction Type", "t_type"),
        ("Payment Method", "coalesce(PaymentType, '')"),
        ("Payment Processer", "coalesce(PaymentProviderName, '')"),
        ("Refund Order ID", "cast(coalesce(refund_no, 0) as bigint)"),
        ("User", "user_shown"),
        ("Product Name", "coalesce(product_name, '')"),
        ("Rental Type", "coalesce(rental_type, '')"),
        ("Rental Start Date", "coalesce(start_day, '')"),
        ("Rental End Date", "coalesce(end_day, '')"),
        ("Location", "coalesce(location_name, '')"),
        ("Subsite Location", "coalesce(site_name, '')"),
        ("Line Item Sub Total", z(m2("line_total"))),
        ("Promo Code ID", "coalesce(coupon_code, '')"),
        ("Coupon Amount", z(m2("-coupon"))),
        ("Line Item Discount", z(m2("-disc"))),
        ("Gratuity", z(m2("tip"))),
        ("Final Line Item Sub Total", z(m2("final_total"))),
        ("Booking Fee", z(m2("booking"))),
        ("Processing Fees", z(m2("fee"))),
        ("Tax %", z(m2("tax_pct"))),
        ("Tax", z(m2("tax"))),
        ("Delivery Fee", z(m2("delivery"))),
        ("Total Collected", z(m2("collected"))),
        ("Partner Name", "coalesce(partner_name, '')"),
        ("Partner ID", "partner"),
        ("order_id_original", "OrderId"),
    ]
    decimals = {n for n, e in shown if e.startswith("coalesce(cast(round(")}
    labels = ",\n  ".join((f'cast({e} as {MONEY}) AS "{n}"' if n in decimals else f'{e} AS "{n}"') for n, e in shown)
    return f"""{REFUND_SUMS},
{ITEM_REFUNDS},
{FIRST_EVENTS},
{COUPONS},
core AS (
  SELECT oi.*, o.OrderNumber, o.PaymentTransactionId AS pay_id, r.ReservationCode, pt.Amount AS paid, pt.ProcessingFee,
         pt.Source, pt.PaymentType, pt.PaymentProviderName, coalesce(rs.total_refund, 0) AS total_refund,
         coalesce(rs.refunded_fee, 0) AS refunded_fee, coalesce(ir.refunded, 0) AS refunded, cl.coupon_code,
         fe.TotalAmount AS f_amount, fe.Total AS f_total, fe.CouponDiscount AS f_coupon, fe.Discount AS f_disc, fe.Tip AS f_tip,
         fe.BookingFee AS f_booking, fe.SalesTax AS f_tax, fe.DeliveryFee AS f_delivery, oh.RefundOrderNumber,
         p.Name AS product_name, l.Name AS location_name, site.Name AS site_name, {NAME} AS user_name,
         pa.Name AS partner_name, rt.Name AS rental_type, coalesce(site.TaxRate, l.TaxRate) AS tax_rate
  FROM m_Orders o
  LEFT JOIN m_Reservations r ON r.Id = o.ReservationId
  LEFT JOIN m_OrderItems oi ON oi.OrderId = o.Id
  LEFT JOIN first_events fe ON fe.OrderItemId = oi.Id
  LEFT JOIN item_refunds ir ON ir.OrderItemId = oi.Id
  LEFT JOIN m_RentalTypes rt ON rt.Id = oi.RentalTypeId
  {DIMENSIONS}
  LEFT JOIN m_PaymentTransactions pt ON pt.Id = o.PaymentTransactionId
  LEFT JOIN refund_sums rs ON rs.PaymentTransactionId = pt.Id
  LEFT JOIN coupon_lists cl ON cl.OrderItemId = oi.Id
  LEFT JOIN m_OrderHistory oh ON oh.OrderId = o.Id
  WHERE {NO_ROOTS}),
paid_lines AS (
  SELECT *, {actual} AS actual, {pick('Total', 'f_total')} AS line_total, {pick('CouponDiscount', 'f_coupon')} AS coupon,
         {pick('Discount', 'f_disc')} AS disc, {pick('Tip', 'f_tip')} AS tip_x, {pick('BookingFee', 'f_booking')} AS booking,
         {pick('SalesTax', 'f_tax')} AS tax, {pick('DeliveryFee', 'f_delivery')} AS delivery
  FROM core WHERE pay_id IS NOT NULL),
payment_rows AS (
  SELECT DISTINCT {same}, 'Payment' AS t_type, {day('CreatedOn')} AS t_date, {day('CreatedOn', fmt=CLOCK)} AS t_time,
         actual AS amount, 0 AS refund_no, line_total, coupon, disc, tip_x AS tip, {net} AS final_total, booking,
         {create} AS fee, tax, delivery,
         {z('tip_x')} + ({net}) + {z('booking')} + {z('tax')} + {z('delivery')} - {create} AS collected
  FROM paid_lines),
refund_rows AS (
  SELECT DISTINCT {same.replace('Id, OrderId,', 'core.Id, core.OrderId,', 1).replace("(CreatedOn ", "(core.CreatedOn ", 1)},
         'Refund' AS t_type, {day('h.CreatedOn')} AS t_date, {day('h.CreatedOn', fmt=CLOCK)} AS t_time,
         h.TotalAmount AS amount, coalesce(core.RefundOrderNumber, 0) AS refund_no, -h.RefundedTotal AS line_total,
         h.RefundedCouponDiscount AS coupon, h.RefundedDiscount AS disc, -h.RefundedTip AS tip, -{e_net} AS final_total,
         -h.RefundedBookingFee AS booking,
         coalesce(-({share('refunded_fee', 'h.RefundedTotalAmount', 'total_refund')}), 0) AS fee,
         -h.RefundedSalesTax AS tax, coalesce(h.RefundedDeliveryFee, 0) AS delivery,
         {refund_total('refunded_fee', 'h.RefundedTotalAmount', 'total_refund', e_parts)} AS collected
  FROM core JOIN ranked_events h ON h.OrderItemId = core.Id WHERE refunded > 0),
report AS (SELECT
  {labels},
  Id AS item_key
  FROM (SELECT * FROM payment_rows UNION ALL SELECT * FROM refund_rows) stacked)"""


def transaction_staged_sql(static: bool) -> str:
    fmt = US if static else "%d/%m/%Y"
    actual = "CASE WHEN refunded > 0 THEN f_amount ELSE TotalAmount END"
    create = share("ProcessingFee", "actual", "paid")
    create = create if static else z(create)

    def pick(now: str, before: str) -> str:
        return f"CASE WHEN refunded = 0 THEN {now} ELSE {before} END"

    net = "sub_total - coupon - disc"
    e_net = "(e_total - e_coupon - e_disc)"
    e_parts = f"{z('-e_tip')} - {e_net} + {z('e_booking')} + {z('-e_tax')} + {z('delivery')}"
    partner = "CASE WHEN PartnerId = 0 THEN '' ELSE coalesce(cast(PartnerId as varchar), '') END"

    def text(x: str) -> str:
        return f"coalesce(cast({x} as varchar), '')"

    shown = [
        ("RID", text("ReservationCode")),
        ("Order Id", text("OrderNumber")),
        ("Line Item Id" if static else "Line Item ID", text("Id")),
        ("Original Order Date", text("original_date")),
        ("Transaction Date", text("t_date")),
        ("Time Stamp", text("t_time")),
        ("Original Line Item Amount", text(m2("actual"))),
        ("Order Type", text("Source")),
        ("Transaction Type", "t_type"),
        ("Payment Method", text("PaymentType")),
        ("Payment Processor" if static else "Payment Processer", text("PaymentProviderName")),
        ("Refund Order ID", "cast(refund_no as varchar)"),
        ("User", "CASE WHEN Source = 'Consumer Web' THEN '' ELSE user_name END"),
        ("Product Name", text("product_name")),
        ("Rental Type", text("rental_type")),
        ("Rental Start Date", text(reread("StartDate", fmt=fmt))),
        ("Rental End Date", text(reread("EndDate", fmt=fmt))),
        ("Location", text("location_name")),
        ("Subsite Location", text("site_name")),
        ("Line Item Sub Amount" if static else "Line Item Sub Total", text(m2("line_total"))),
        ("Promo Code ID", text("coupon_code")),
        ("Coupon Amount", text(m2("coupon_shown"))),
        ("Line Item Discount", text(m2("disc_shown"))),
        ("Gratuity", text(m2("tip_shown"))),
        ("Final Line Item Sub Total", text(m2("final_total"))),
        ("Booking Fee", text(m2("booking"))),
        ("Processing Fees", text(m2("fee"))),
        ("Tax %", m2("tax_rate")),
        ("Tax", text(m2("tax"))),
        ("Delivery Fee", text(m2("delivery"))),
        ("Total Collected", text(f"cast({z(m2('collected'))} as {MONEY})")),
        ("Partner Name", text("partner_name")),
        ("Partner ID", partner),
    ]
    if static:
        shown.append(("Tax Counties", "''"))
    else:
        shown.append(("order_id_original", "OrderId"))
    labels = ",\n  ".join(f'{e} AS "{n}"' for n, e in shown)
    carried = """Id, OrderId, ReservationCode, OrderNumber, original_date, Source, PaymentType, PaymentProviderName, user_name, product_name,
         rental_type, StartDate, EndDate, location_name, site_name, coupon_code, tax_rate, partner_name, PartnerId, actual, delivery"""
    return f"""{REFUND_SUMS},
{FIRST_EVENTS},
{COUPONS},
base AS (
  SELECT oi.*, o.OrderNumber, r.ReservationCode, pt.Amount AS paid, pt.ProcessingFee, pt.Source, pt.PaymentType,
         pt.PaymentProviderName, coalesce(rs.total_refund, 0) AS total_refund, coalesce(rs.refunded_fee, 0) AS refunded_fee,
         coalesce(fe.RefundedTotalAmount, 0) AS refunded, cl.coupon_code, fe.Id AS event_id, fe.CreatedOn AS e_time,
         fe.TotalAmount AS f_amount, fe.Total AS f_total, fe.CouponDiscount AS f_coupon, fe.Discount AS f_disc, fe.Tip AS f_tip,
         fe.RefundedTotal AS e_total, fe.RefundedCouponDiscount AS e_coupon, fe.RefundedDiscount AS e_disc, fe.RefundedTip AS e_tip,
         fe.RefundedBookingFee AS e_booking, fe.RefundedSalesTax AS e_tax,
         p.Name AS product_name, l.Name AS location_name, site.Name AS site_name, {NAME} AS user_name,
         pa.Name AS partner_name, rt.Name AS rental_type, coalesce(site.TaxRate, l.TaxRate) AS tax_rate
  FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId
  LEFT JOIN m_Reservations r ON r.Id = o.ReservationId
  LEFT JOIN first_events fe ON fe.OrderItemId = oi.Id
  LEFT JOIN m_RentalTypes rt ON rt.Id = oi.RentalTypeId
  {DIMENSIONS}
  LEFT JOIN m_PaymentTransactions pt ON pt.OrderId = o.Id
  LEFT JOIN refund_sums rs ON rs.PaymentTransactionId = pt.Id
  LEFT JOIN coupon_lists cl ON cl.OrderItemId = oi.Id
  WHERE {NO_ROOTS}),
priced AS (
  SELECT * EXCLUDE (Tip), {day('b.CreatedOn', fmt=fmt)} AS original_date, {actual} AS actual, coalesce({pick('Total', 'f_total')}, 0) AS sub_total,
         coalesce({pick('CouponDiscount', 'f_coupon')}, 0) AS coupon, coalesce({pick('Discount', 'f_disc')}, 0) AS disc,
         {pick('Tip', 'f_tip')} AS tip, {m2('BookingFee')} AS book, {m2('DeliveryFee')} AS delivery,
         {m2('SalesTax + coalesce(e_tax, 0)')} AS tax_now
  FROM base b),
payments AS (
  SELECT y.* FROM (SELECT *, {create} AS create_fee FROM priced) y LEFT JOIN m_OrderHistory oh ON oh.OrderId = y.OrderId),
report AS (SELECT
  {labels},
  Id AS item_key
  FROM (
    SELECT {carried}, original_date AS t_date, {day('CreatedOn', fmt=CLOCK)} AS t_time, 'Payment' AS t_type, cast(NULL as bigint) AS refund_no,
           sub_total AS line_total, -coupon AS coupon_shown, -disc AS disc_shown, coalesce(tip, 0) AS tip_shown,
           {net} AS final_total, book AS booking, create_fee AS fee, tax_now AS tax,
           tip + ({net}) + book + tax_now + delivery - create_fee AS collected
    FROM payments
    UNION ALL
    SELECT {re.sub(r'\bId, OrderId', 'x.Id, x.OrderId', carried, count=1)}, {day('e_time', fmt=fmt)}, {day('e_time', fmt=CLOCK)}, 'Refund', oh.RefundOrderNumber,
           -e_total, e_coupon, e_disc, e_tip, -{e_net}, e_booking,
           -({share('refunded_fee', 'refunded', 'total_refund')}), -e_tax,
           {refund_total('refunded_fee', 'refunded', 'total_refund', e_parts)}
    FROM payments x LEFT JOIN m_OrderHistory oh ON oh.OrderId = x.OrderId WHERE event_id IS NOT NULL) stacked)"""


def wide(report: str, live: bool = True) -> str:
    blanks = ", ".join(f"""coalesce(cast("{n}" as varchar), '') AS "{n}\"""" for n in DYNAMIC)
    return f"""WITH {report},
{all_pivots(live)}
SELECT coalesce(cast(columns(r.* EXCLUDE (order_id_original, item_key)) as varchar), ''), {blanks}
FROM report r LEFT JOIN order_pivot op ON op.order_id = r.order_id_original
LEFT JOIN product_pivot pp ON pp.order_item_id = r.item_key
LEFT JOIN location_pivot lp ON lp.order_item_id = r.item_key"""


# --- first-generation reports


def dbl(x: str) -> str:
    return f"cast({x} as double)"


LAYERED = f"""{COUPONS},
lines AS (
  SELECT o.Id AS order_id, oi.Id AS order_item_id, r.ReservationCode, o.OrderNumber, oi.CreatedOn AS created, {dbl('pt.Amount')} AS paid,
         {dbl('oh.RefundedTotal')} AS order_refund, {dbl('o.Total')} AS total, pt.Source, pt.PaymentType, pt.PaymentProviderName,
         oi.IsRefunded, CASE WHEN u.Id IS NULL THEN NULL ELSE {NAME} END AS user_name, p.Name AS product_name, oi.StartDate, oi.EndDate,
         l.Name AS location_name, site.Name AS site_name, {dbl('oi.Total')} AS item_total, {dbl('oi.TotalAmount')} AS item_amount,
         cl.coupon_code, {dbl('oi.CouponDiscount')} AS coupon, {dbl('oi.Discount')} AS disc, {dbl('oi.Tip')} AS tip,
         {dbl('o.BookingFee')} AS booking, {dbl('pt.ProcessingFee')} AS fee, {dbl('pr.RefundedProcessingFee')} AS rfee,
         coalesce(site.TaxRate, l.TaxRate) AS tax_rate, {dbl('oi.SalesTax')} AS tax, {dbl('o.DeliveryFee')} AS order_delivery,
         {dbl('oi.DeliveryFee')} AS item_delivery, pa.Name AS partner_name, oi.PartnerId, pt.Id AS payment_id,
         oh.refund_number
  FROM m_Orders o
  LEFT JOIN m_Reservations r ON r.Id = o.ReservationId
  LEFT JOIN m_OrderItems oi ON oi.OrderId = o.Id
  LEFT JOIN (SELECT OrderId, sum(RefundedTotal) AS RefundedTotal, string_agg(DISTINCT cast(RefundOrderNumber as varchar), ', ' ORDER BY cast(RefundOrderNumber as varchar)) AS refund_number
             FROM m_OrderHistory GROUP BY OrderId) oh ON oh.OrderId = o.Id
  {DIMENSIONS}
  LEFT JOIN m_PaymentTransactions pt ON pt.OrderId = o.Id
  LEFT JOIN (SELECT PaymentTransactionId, sum(RefundedProcessingFee) AS RefundedProcessingFee
             FROM m_PaymentRefund GROUP BY PaymentTransactionId) pr ON pr.PaymentTransactionId = pt.Id
  LEFT JOIN coupon_lists cl ON cl.OrderItemId = oi.Id)"""
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def layered_report(clamped: bool) -> str:
    n0 = (lambda x: f"coalesce({x}, 0.0::double)")
    sub = f"greatest({n0('item_amount')} - {n0('coupon')} - {n0('disc')}, 0.0::double)" if clamped else "item_amount - coupon - disc"
    if clamped:
        create, back = f"{n0('fee')} * item_amount / nullif(total, 0)", f"{n0('rfee')} * item_amount / nullif(total, 0)"
        both = f"({n0('fee')} + {n0('rfee')}) * item_amount / nullif(total, 0)"
        booking = "booking * item_amount / nullif(total, 0)"
        collected = f"({n0('paid')} - {n0('order_refund')} - {n0('rfee')}) * item_amount / nullif(total, 0)"
    else:
        create, back = "fee * (item_amount / nullif(total, 0))", "rfee * (item_amount / nullif(total, 0))"
        both = f"(fee + {n0('rfee')}) * (item_amount / nullif(total, 0))"
        booking, collected = "booking", f"paid - order_refund - {n0('rfee')}"
    provider = "coalesce(PaymentProviderName, 'Unknown')" if clamped else "PaymentProviderName"
    return f"""WITH {LAYERED}
SELECT ReservationCode AS "RID", OrderNumber AS "Order Id", order_item_id AS "Line Item Id", {STAMP.format('created')} AS "Order Date",
  paid AS "Original Order Amount", order_refund AS "Order Refunded Amount", total AS "Order Amount", Source AS "OrderType",
  PaymentType AS "Payment Method", {provider} AS "Payment Processer", IsRefunded AS "Refunded?", user_name AS "User",
  product_name AS "Product Name", {STAMP.format('StartDate')} AS "Rental Start Date", {STAMP.format('EndDate')} AS "Rental End Date",
  location_name AS "Location", site_name AS "Substitue Location", {'item_amount' if clamped else 'item_total'} AS "Line Item Sub Total",
  coupon_code AS "Promo Code Id", coupon AS "Coupon Amount", disc AS "Line Item Discount", tip AS "Gratuity",
  {sub} AS "Final Line Item Sub Total", {booking} AS "Booking Fee", {create} AS "Create Line Item Payment Processor Fee",
  {back} AS "Refund Line Item Payment Processor Fee", {both} AS "Total Line Item Payment Processor Fee",
  {m2('tax_rate') if clamped else dbl('tax_rate')} AS "Tax%", tax AS "Tax", {'item_delivery' if clamped else 'order_delivery'} AS "Delivery Fee",
  {collected} AS "Total Collected", partner_name AS "Parner Name", PartnerId AS "PartnerId"
FROM lines"""


REFUND_REPORT = f"""WITH {LAYERED}
SELECT ReservationCode AS "RID", OrderNumber AS "OrderId", order_item_id AS "LineItemId", {STAMP.format('created')} AS "OriginalOrderDate",
  item_amount AS "OriginalLineItemAmount", Source AS "OrderType", order_refund AS "RefundAmount",
  PaymentType AS "PaymentMethod", PaymentProviderName AS "PaymentProcessor", refund_number AS "RefundOrderId",
  user_name AS "User", product_name AS "ProductName", {STAMP.format('StartDate')} AS "RentalStartDate",
  {STAMP.format('EndDate')} AS "RentalEndDate", location_name AS "LocationName", site_name AS "SubsiteLocationName",
  {m2('tax_rate')} AS "TaxPercent", item_amount AS "LineItemSubTotal", coupon_code AS "PromoCodeId", coupon AS "CouponAmount",
  disc AS "LineItemDiscount", tip AS "Gratuity", item_amount - coupon - disc AS "FinalLineItemSubTotal", booking AS "BookingFee",
  fee AS "ProcessingFees", tax AS "Tax", item_delivery AS "DeliveryFee",
  paid - order_refund - coalesce(rfee, 0.0::double) AS "TotalCollected",
  partner_name AS "PartnerName", PartnerId AS "PartnerId"
FROM lines"""
_VIEW = f"""o.Id AS order_id, oi.Id AS order_item_id, pt.Id AS payment_transaction_id, {dbl('pt.Amount')} AS paid_amount,
  {dbl('pt.ProcessingFee')} AS processing_fee, {dbl('o.Total')} AS total, {dbl('oi.SalesTax')} AS sales_tax, {dbl('o.BookingFee')} AS booking_fee,
  {dbl('o.DeliveryFee')} AS delivery_fee, pt.PaymentType AS payment_type, pt.PaymentProviderName AS payment_provider_name,
  l.Name AS location_name, {dbl('l.TaxRate')} AS tax_rate, site.Name AS site_name, {dbl('site.TaxRate')} AS site_tax_rate"""
_VIEW_FROM = """FROM m_Orders o LEFT JOIN m_OrderItems oi ON oi.OrderId = o.Id LEFT JOIN m_PaymentTransactions pt ON pt.OrderId = o.Id
LEFT JOIN m_Locations l ON l.Id = oi.LocationId LEFT JOIN m_Locations site ON site.Id = oi.SiteId"""
PAYMENTS_VIEW = f"""SELECT {_VIEW}, CASE WHEN pt.Id IS NOT NULL THEN (SELECT count(*) FROM m_PaymentRefund pr WHERE pr.PaymentTransactionId = pt.Id) END AS refund_count
{_VIEW_FROM}"""
PAYMENTS_VIEW_REPEATED = f"SELECT {_VIEW} {_VIEW_FROM} LEFT JOIN m_PaymentRefund pr ON pr.PaymentTransactionId = pt.Id"


def staged_counts(table: str) -> str:
    """Counts of a staged table by kind of column."""
    columns = SNAPSHOT_COLUMNS[table]
    kind = {**dict.fromkeys(("CreatedOn", "ModifiedOn", "StartDate", "EndDate"), "time"), **dict.fromkeys(("IsALaCarte", "IsRefunded", "ShowInExport", "IsDeleted"), "flag")}
    kind |= dict.fromkeys(("OrderNumber", "RefundOrderNumber", "RefundedQuantity", "DynamicControlType", "PartnerId"), "")
    kind |= dict.fromkeys(columns if table == "Partners" else (), "") | ({"Name": "text", "CreatedOn": "time", "ModifiedOn": "time"} if table == "Partners" else {})
    amounts = ("Fee", "Total", "Discount", "Tip", "Tax", "Amount", "TaxRate")
    found = {c: kind.get(c, "money" if c.endswith(amounts) else "text") for c in columns}

    def values(k: str) -> str:
        return " + ".join([f"count({c})" for c in columns if found[c] == k]) or "0"

    sums = ", ".join(f"cast({values(k)} as bigint) AS {k}_values" for k in ("money", "time", "text", "flag"))
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, count(*) - count({columns[0]}) AS null_keys, {sums} FROM m_{table}"


def layered_formula(*exprs: str) -> str:
    return f"WITH {LAYERED} SELECT order_id, order_item_id, payment_id, rfee AS refunded_processing_fee, order_refund AS order_level_refund, {', '.join(exprs)} FROM lines"


ORDER_CURRENT = order_sql("current")
FINAL = "SELECT * EXCLUDE (item_key) FROM report"
EVENTS = "SELECT * FROM m_OrderItemsHistory WHERE RefundedTotalAmount > 0"
RANKED = "row_number() OVER (PARTITION BY OrderItemId ORDER BY CreatedOn NULLS LAST, Id)"
PRODUCT_ATTRS, LOCATION_ATTRS = scope_attrs("product", 0), scope_attrs("location", 1)
COUNTED = {"orders", "lineitem", "customer", "part", "supplier", "nation", "region"}
UUID = "concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32])"

SQL = {
    "scan_catalog": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in sorted(COUNTED)),
    "snapshot_pruned": "SELECT * REPLACE ("
    + ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}" for n in ("CreatedOn", "ModifiedOn", "StartDate", "EndDate"))
    + ") FROM m_OrderItems",
    "snapshot_full": "SELECT * FROM customer",
    "disambiguate_names": " UNION ALL ".join(
        f"SELECT '{p}DynamicControlOptions' AS table_name, DynamicControlId, count(*) AS n_options FROM m_{p}DynamicControlOptions GROUP BY DynamicControlId"
        for p in ("Order", "Product", "Location")
    ),
    "materialize_stage": f"SELECT LocationId AS location_id, count(*) AS n_items, cast(sum(TotalAmount) as {MONEY}) AS amount FROM m_OrderItems oi WHERE {NO_ROOTS} GROUP BY LocationId",
    "overwrite_idempotent": "SELECT Id, ReservationCode FROM m_Reservations",
    "named_view": f"SELECT order_id, order_item_id, payment_transaction_id, paid_amount, location_name, site_name FROM ({PAYMENTS_VIEW_REPEATED}) v",
    "literal_table": f"SELECT OrderNumber AS order_number, OrderNumber IN (SELECT order_number FROM {LISTED} i) AS listed FROM m_Orders",
    "report_sink": f'WITH {ORDER_CURRENT} SELECT "Line Item ID" AS line_item, "Total Collected" AS total_collected, "Order Amount" AS order_amount FROM report',
    "csv_report_io": "SELECT Id, Source, PaymentType, concat('say \"', Status, '\",', chr(10), 'ok', chr(10), chr(10), '\"') AS Note, cast(Amount as varchar) AS Amount FROM m_PaymentTransactions",
    "rename_project": """SELECT Id AS order_item_id, OrderId AS order_id, ProductId AS product_id, LocationId AS location_id, SiteId AS site_id,
  RentalTypeId AS rental_type_id, CouponDiscount AS coupon_discount, Tip AS tip, Discount AS discount, SalesTax AS sales_tax, DeliveryFee AS item_delivery_fee,
  TotalAmount AS total_amount_items, Total AS total_items, IsRefunded AS is_refunded, PartnerId AS partner_id FROM m_OrderItems""",
    "label_project": f'SELECT Id AS "Line Item Id", {m2("Tip")} AS "Gratuity", SalesTax AS "Tax", PartnerId AS "PartnerId" FROM m_OrderItems',
    "carry_forward_star": f"SELECT * EXCLUDE (CreatedOn, ModifiedOn), RefundOrderNumber IS NOT NULL AS has_refund_order, cast(RefundedTotal * 2 as {MONEY}) AS twice FROM m_OrderHistory",
    "constant_column": "SELECT Id AS order_item_id, 'Payment' AS transaction_type, '' AS tax_counties, cast(NULL as varchar) AS refund_order, cast(0 as bigint) AS refund_no FROM m_OrderItems",
    "filter_root_alacarte": f"SELECT Id AS order_item_id, OrderId AS order_id FROM m_OrderItems oi WHERE {NO_ROOTS}",
    "filter_positive_refund": f"SELECT Id, OrderItemId, RefundedTotalAmount FROM ({EVENTS}) e",
    "filter_has_payment": "SELECT Id, PaymentTransactionId FROM m_Orders WHERE PaymentTransactionId IS NOT NULL",
    "filter_exported_controls": "WITH " + order_attrs("control_name") + " SELECT * FROM order_attrs",
    "filter_live_values": "SELECT ProductId, DynamicControlOptionId FROM m_ProductDynamicControlValues WHERE IsDeleted = false",
    "filter_control_scope": "SELECT Id, OrderItemId, DynamicControlOptionId, CASE DynamicControlType WHEN 0 THEN 'product' ELSE 'location' END AS scope FROM m_OrderItemDynamicControls",
    "filter_point_lookup": "SELECT oi.Id AS order_item_id, o.OrderNumber, oi.TotalAmount AS total_amount FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId WHERE o.OrderNumber = 100000000042",
    "filter_refund_id_null": """SELECT Id, concat('null/', CASE WHEN RefundOrderNumber IS NULL THEN 'payment' ELSE 'refund' END) AS part FROM m_OrderHistory
  UNION ALL SELECT Id, concat('zero/', CASE WHEN coalesce(RefundOrderNumber, 0) = 0 THEN 'payment' ELSE 'refund' END) FROM m_OrderHistory""",
    "drop_helper_columns": "SELECT Id, Amount, RefundedProcessingFee FROM m_PaymentRefund",
    "left_join_chain_base": """SELECT o.Id AS order_id, o.OrderNumber AS order_number, r.ReservationCode AS reservation_code, oi.Id AS order_item_id, oi.TotalAmount AS total_amount
  FROM m_Orders o LEFT JOIN m_Reservations r ON r.Id = o.ReservationId LEFT JOIN m_OrderItems oi ON oi.OrderId = o.Id""",
    "inner_join_item_first": f"SELECT oi.Id AS order_item_id, o.Id AS order_id, o.OrderNumber AS order_number, o.Total AS order_total FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId WHERE {NO_ROOTS}",
    "dimension_enrich": "SELECT oi.Id AS order_item_id, p.Name AS product_name, pa.Name AS partner_name FROM m_OrderItems oi LEFT JOIN m_Products p ON p.Id = oi.ProductId LEFT JOIN m_Partners pa ON pa.Id = oi.PartnerId",
    "role_playing_self_dim": "SELECT oi.Id AS order_item_id, l.Name AS location_name, s.Name AS site_name FROM m_OrderItems oi LEFT JOIN m_Locations l ON l.Id = oi.LocationId LEFT JOIN m_Locations s ON s.Id = oi.SiteId",
    "payment_by_order": "SELECT o.Id AS order_id, pt.Id AS payment_transaction_id, pt.Amount AS paid_amount, pt.Source AS payment_source FROM m_Orders o LEFT JOIN m_PaymentTransactions pt ON pt.OrderId = o.Id",
    "payment_by_id": "SELECT o.Id AS order_id, o.PaymentTransactionId AS payment_transaction_id, pt.Amount AS paid_amount, pt.Source AS payment_source FROM m_Orders o LEFT JOIN m_PaymentTransactions pt ON pt.Id = o.PaymentTransactionId",
    "join_preaggregated": f"WITH {ITEM_REFUNDS} SELECT oi.Id AS order_item_id, oi.TotalAmount AS total_amount, cast(coalesce(ir.refunded, 0) as {MONEY}) AS sum_refunded FROM m_OrderItems oi LEFT JOIN item_refunds ir ON ir.OrderItemId = oi.Id",
    "join_unaggregated_refund": "SELECT pt.Id AS payment_transaction_id, pt.OrderId AS order_id, pr.Id AS refund_id, pr.Amount AS refund_amount FROM m_PaymentTransactions pt LEFT JOIN m_PaymentRefund pr ON pr.PaymentTransactionId = pt.Id",
    "join_ranked_first": f"WITH {FIRST_EVENTS} SELECT oi.Id AS order_item_id, fe.Id AS event_id, fe.RefundedTotalAmount AS amount, oi.TotalAmount AS total_amount FROM m_OrderItems oi LEFT JOIN first_events fe ON fe.OrderItemId = oi.Id",
    "inner_join_refund_events": f"WITH {FIRST_EVENTS} " + " UNION ALL ".join(
        f"SELECT '{w}' AS which, oi.Id AS order_item_id, e.Id AS event_id, e.RefundedTotalAmount AS amount, oi.TotalAmount AS total_amount FROM m_OrderItems oi JOIN {t} e ON e.OrderItemId = oi.Id"
        for w, t in (("all", "ranked_events"), ("first", "first_events"))
    ),
    "join_order_history": """WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY OrderId ORDER BY CreatedOn DESC, Id DESC) AS rn FROM m_OrderHistory) x WHERE rn = 1)
  SELECT 'all' AS mode, o.Id AS order_id, o.OrderNumber AS order_number, h.Id AS order_history_id, h.RefundOrderNumber AS refund_order_number FROM m_Orders o LEFT JOIN m_OrderHistory h ON h.OrderId = o.Id
  UNION ALL SELECT 'latest', o.Id, o.OrderNumber, h.Id, h.RefundOrderNumber FROM m_Orders o LEFT JOIN latest h ON h.OrderId = o.Id""",
    "eav_resolve": """SELECT v.ProductId AS product_id, dc.DisplayName AS control_name, op.Option AS control_value FROM m_ProductDynamicControlValues v
  JOIN m_ProductDynamicControlOptions op ON v.DynamicControlOptionId = op.Id JOIN m_ProductDynamicControls dc ON op.DynamicControlId = dc.Id WHERE dc.ShowInExport = true""",
    "eav_expand_to_items": f"WITH {PRODUCT_ATTRS} SELECT * FROM product_all",
    "anti_join_cte": f"WITH {PRODUCT_ATTRS} SELECT * FROM product_all a WHERE NOT EXISTS (SELECT 1 FROM product_own w WHERE w.order_item_id = a.order_item_id)",
    "anti_join_correlated": """SELECT oi.Id AS order_item_id, oi.LocationId AS location_id FROM m_OrderItems oi WHERE NOT EXISTS (
  SELECT 1 FROM m_OrderItemDynamicControls x JOIN m_LocationDynamicControlOptions op ON x.DynamicControlOptionId = op.Id
  JOIN m_LocationDynamicControls dc ON op.DynamicControlId = dc.Id WHERE x.OrderItemId = oi.Id AND x.DynamicControlType = 1 AND dc.ShowInExport = true)""",
    "semi_join_in": "SELECT Id AS order_id, OrderNumber AS order_number FROM m_Orders WHERE Id IN (SELECT OrderId FROM m_PaymentTransactions WHERE Source = 'Consumer Web')",
    "join_expected_ids": f"SELECT cast(o.OrderNumber as varchar) AS order_number, o.Total AS order_total FROM m_Orders o JOIN {IDS} i ON i.order_number = o.OrderNumber",
    "join_dynamic_columns": f"""WITH {all_pivots()} SELECT oi.Id AS order_item_id, oi.OrderId AS order_id, {', '.join(f'"{n}"' for n in DYNAMIC)}
  FROM m_OrderItems oi LEFT JOIN order_pivot a ON a.order_id = oi.OrderId LEFT JOIN product_pivot b ON b.order_item_id = oi.Id LEFT JOIN location_pivot d ON d.order_item_id = oi.Id""",
    "agg_refund_total_by_item": f"WITH {ITEM_REFUNDS} SELECT OrderItemId AS order_item_id, cast(refunded as {MONEY}) AS sum_refunded FROM item_refunds",
    "agg_first_by_time": f"WITH {FIRST_EVENTS} SELECT OrderItemId, TotalAmount AS earliest_total_amount, RefundedDiscount AS first_discount FROM first_events",
    "agg_payment_refunds": f"""SELECT PaymentTransactionId AS payment_transaction_id, cast(sum(Amount) as decimal(24,4)) AS sum_total_refund_amount, cast(sum(RefundedProcessingFee) as decimal(24,4)) AS sum_refunded_processing_fee,
  {m2('sum(Amount)')} AS rounded_amount, {m2('sum(RefundedProcessingFee)')} AS rounded_fee FROM m_PaymentRefund GROUP BY PaymentTransactionId""",
    "agg_payment_refunds_joined": """SELECT pt.Id AS payment_transaction_id, cast(sum(pr.Amount) as decimal(24,4)) AS sum_total_refund_amount, cast(sum(pr.RefundedProcessingFee) as decimal(24,4)) AS sum_refunded_processing_fee
  FROM m_PaymentTransactions pt JOIN m_PaymentRefund pr ON pr.PaymentTransactionId = pt.Id GROUP BY pt.Id""",
    "agg_coupon_list": f"WITH {COUPONS} SELECT OrderItemId AS order_item_id, coupon_code FROM coupon_lists",
    "agg_coupon_list_left": f"WITH {COUPONS.replace(' JOIN m_Coupons', ' LEFT JOIN m_Coupons')} SELECT OrderItemId AS order_item_id, coupon_code FROM coupon_lists",
    "agg_control_values": f"WITH {ORDER_ATTRS} SELECT order_id, control_name, string_agg(control_value, ', ' ORDER BY control_value) AS control_value FROM order_attrs GROUP BY order_id, control_name",
    "distinct_rows": "SELECT DISTINCT * FROM m_OrderCoupons",
    "distinct_controls": f"WITH {ORDER_ATTRS}, {PRODUCT_ATTRS}, {LOCATION_ATTRS} " + " UNION ALL ".join(
        f"SELECT '{s}' AS scope, cast(row_number() OVER (ORDER BY control_name) as int) AS position, control_name FROM (SELECT DISTINCT control_name FROM {s}_attrs) {s}_names"
        for s in ("order", "product", "location")
    ),
    "count_rows": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) = 0 AS is_empty FROM m_{t}" for t in ("Orders", "OrderItems", "OrderItemsHistory", "PaymentRefund")),
    "count_distinct_keys": "SELECT count(DISTINCT OrderId) AS n_orders, count(DISTINCT Id) AS n_line_items FROM m_OrderItems",
    "window_earliest_event": f"WITH {FIRST_EVENTS} SELECT OrderItemId AS order_item_id, Id AS event_id, RefundedTotalAmount AS amount, {STAMP.format('CreatedOn')} AS event_time FROM first_events",
    "window_rank_all": f"SELECT OrderItemId AS order_item_id, Id AS event_id, {RANKED} AS rn FROM ({EVENTS}) e",
    "window_partition_sum": f"SELECT OrderItemId AS order_item_id, Id AS event_id, RefundedTotalAmount AS amount, cast(sum(RefundedTotalAmount) OVER (PARTITION BY OrderItemId) as {MONEY}) AS sum_amount FROM ({EVENTS}) e",
    "sort_report": 'SELECT Id AS "Line Item ID", TotalAmount AS amount FROM m_OrderItems ORDER BY Id',
    "limit_preview": "SELECT Id AS order_item_id, OrderId AS order_id, TotalAmount AS total_amount FROM m_OrderItems ORDER BY TotalAmount, Id LIMIT 50",
    "union_payment_refund": f"""SELECT Id AS order_item_id, 'Payment' AS transaction_type, cast(TotalAmount as {MONEY}) AS amount, cast(NULL as varchar) AS refund_order FROM m_OrderItems
  UNION ALL SELECT OrderItemId, 'Refund', cast(-RefundedTotalAmount as {MONEY}), Id FROM ({EVENTS}) e""",
    "union_override_scope": f"WITH {PRODUCT_ATTRS} SELECT * FROM product_attrs",
    "fn_coalesce_zero": of_items(f"cast({z('Tip')} as {MONEY})"),
    "fn_coalesce_blank": of_items("coalesce(SiteId, '')"),
    "fn_coalesce_default": "SELECT Id, coalesce(PaymentProviderName, 'Unknown') AS result FROM m_PaymentTransactions",
    "fn_coalesce_priority": "SELECT oi.Id AS order_item_id, coalesce(s.TaxRate, l.TaxRate) AS result FROM m_OrderItems oi LEFT JOIN m_Locations l ON l.Id = oi.LocationId LEFT JOIN m_Locations s ON s.Id = oi.SiteId",
    "fn_nullif_safe_divide": of_items(share("Tip", "DeliveryFee", "CouponDiscount")),
    "fn_round2": of_items(m2("(Total - 50000) * cast(0.125 as decimal(4,3))")),
    "fn_greatest_clamp": of_items(f"cast(greatest(Tip - BookingFee, 0) as {MONEY})"),
    "fn_case_flag": of_items(f"CASE WHEN {z('CouponDiscount')} > 0 THEN true ELSE IsRefunded END"),
    "fn_case_pick_amount": of_lines(m2("CASE WHEN coalesce(refunded, 0) > 0 THEN BookingFee ELSE TotalAmount END")),
    "fn_case_pick_history": f"""WITH {FIRST_EVENTS} SELECT oi.Id AS order_item_id, CASE WHEN fe.Id IS NULL THEN oi.Tip ELSE fe.Tip END AS tip, CASE WHEN fe.Id IS NULL THEN oi.Total ELSE fe.Total END AS total
  FROM m_OrderItems oi LEFT JOIN first_events fe ON fe.OrderItemId = oi.Id""",
    "fn_mask_user": f"""SELECT o.Id AS order_id, CASE WHEN pt.Source = 'Consumer Web' THEN '' ELSE {NAME} END AS result FROM m_Orders o
  LEFT JOIN m_PaymentTransactions pt ON pt.Id = o.PaymentTransactionId LEFT JOIN m_Users u ON u.Id = o.CreatedBy""",
    "fn_partner_id_text": of_items("CASE WHEN PartnerId = 0 THEN '' ELSE coalesce(cast(PartnerId as varchar), '') END"),
    "fn_concat_nullsafe": f"SELECT Id, {NAME} AS result FROM m_Users u",
    "fn_bool_text_upper": of_items("upper(cast(IsRefunded as varchar))"),
    "fn_negate": of_items("-Discount"),
    "fn_cast_text": of_items(f"concat_ws('|', cast(cast(DeliveryFee as {MONEY}) as varchar), cast(PartnerId as varchar))"),
    "fn_cast_uuid": f"SELECT Id AS order_item_id, CASE WHEN Id LIKE '%4' THEN NULL ELSE {UUID} END AS result FROM (SELECT Id, md5(Id) AS h FROM m_OrderItems) x",
    "fn_cast_bigint": "SELECT Id AS order_item_id, cast(Id as bigint) AS strict, try_cast(coalesce(SiteId, ProductId) as bigint) AS tolerant FROM m_OrderItems",
    "fn_replace_quotes": """SELECT v.OrderId, v.DynamicControlOptionId, replace(dc.DisplayName, '"', '') AS result FROM m_OrderDynamicControlValues v
  JOIN m_OrderDynamicControlOptions op ON v.DynamicControlOptionId = op.Id JOIN m_OrderDynamicControls dc ON op.DynamicControlId = dc.Id WHERE dc.ShowInExport = true""",
    "fn_local_date": of_items(f"concat_ws('|', {day('CreatedOn')}, {day('CreatedOn', fmt=US)})"),
    "fn_local_time": of_items(day("CreatedOn", fmt=CLOCK)),
    "fn_double_shift_date": of_items(f"concat_ws('|', {reread('StartDate')}, {reread('StartDate', session='UTC')})"),
    "fn_utc_roundtrip": of_items(reread("CreatedOn", session="UTC", fmt=US, via="UTC")),
    "final_subtotal": of_lines(m2("Total - CouponDiscount - Discount")),
    "final_subtotal_total_amount": of_lines(m2("TotalAmount - CouponDiscount - Discount")),
    "final_subtotal_clamped": of_lines(f"cast(greatest({z('Tip')} - {z('CouponDiscount')} - {z('Discount')}, 0) as {MONEY})"),
    "prorate_create_fee": of_lines(f"{CREATE} AS result, cast({z(CREATE)} as {MONEY})", "filled"),
    "prorate_refund_fee": of_lines(f"cast({BACK} as {MONEY})"),
    "prorate_total_fee": of_lines(f"cast({z(CREATE)} - {z(BACK)} as {MONEY})"),
    "total_collected_order": of_lines(f"cast(coalesce({PARTS} - ({z(CREATE)} - {z(BACK)}), 0) as {MONEY})"),
    "total_collected_payment": of_lines(f"cast(coalesce({PARTS} - {z(CREATE)}, 0) as {MONEY})"),
    "total_collected_refund": f"WITH {EVENT_LINES} SELECT event_id, cast({refund_total(z('refunded_fee'), 'e_amount', z('total_refund'), E_PARTS)} as {MONEY}) AS result FROM event_lines",
    "refund_sign_rules": f"WITH {EVENT_LINES} SELECT event_id, -e_total AS event_total, e_coupon AS event_coupon, e_discount AS event_discount, -e_tip AS event_tip, -e_booking AS event_booking, -e_tax AS event_tax, e_delivery AS event_delivery FROM event_lines",
    "refund_fee_signed": f"WITH {EVENT_LINES} SELECT event_id, {SIGNED_FEE} AS result FROM event_lines",
    "prorate_by_order_total": layered_formula(
        "fee * (item_amount / nullif(total, 0)) AS create_fee", "rfee * (item_amount / nullif(total, 0)) AS refund_fee", "(fee + coalesce(rfee, 0.0::double)) * (item_amount / nullif(total, 0)) AS total_fee"
    ),
    "prorate_booking_fee": layered_formula("booking * item_amount / nullif(total, 0) AS result"),
    "total_collected_order_level": layered_formula("paid - order_refund - coalesce(rfee, 0.0::double) AS result"),
    "total_collected_prorated": layered_formula("(coalesce(paid, 0.0::double) - coalesce(order_refund, 0.0::double) - coalesce(rfee, 0.0::double)) * item_amount / nullif(total, 0) AS result"),
    "scoped_override": f"WITH {LOCATION_ATTRS} SELECT * FROM location_attrs",
    "pivot_order_controls": f"WITH {ORDER_ATTRS}, {pivot('order', 'order_id')} SELECT * FROM order_pivot",
    "pivot_product_controls": f"WITH {PRODUCT_ATTRS}, {pivot('product', 'order_item_id')} SELECT * FROM product_pivot",
    "pivot_location_controls": f"WITH {LOCATION_ATTRS}, {pivot('location', 'order_item_id')} SELECT * FROM location_pivot",
    "pivot_empty_guard": "SELECT Id AS order_id, cast(NULL as boolean) AS found FROM m_Orders",
    "column_reorder": f'WITH {LOCATION_ATTRS}, {pivot("location", "order_item_id")} SELECT order_item_id, "Tax Counties", 1 AS ordinal FROM location_pivot',
    "blank_all_nulls": f"SELECT Id AS order_item_id, coalesce(SiteId, '') AS site_id, coalesce(cast(cast(Tip as {MONEY}) as varchar), '') AS tip, coalesce(cast(IsRefunded as varchar), '') AS is_refunded_source, coalesce(cast(PartnerId as varchar), '') AS partner_id FROM m_OrderItems",
    "order_report": f"WITH {ORDER_CURRENT} {FINAL}",
    "order_report_dynamic": wide(ORDER_CURRENT),
    "transaction_report": f"WITH {transaction_current_sql()} {FINAL}",
    "transaction_report_dynamic": wide(transaction_current_sql()),
    "order_report_static": f"WITH {order_sql('static')} {FINAL}",
    "order_report_staged": f"WITH {order_sql('staged')} {FINAL}",
    "order_report_staged_dynamic": wide(order_sql("staged"), live=False),
    "transaction_report_static": f"WITH {transaction_staged_sql(True)} {FINAL}",
    "transaction_report_staged": f"WITH {transaction_staged_sql(False)} {FINAL}",
    "transaction_report_staged_dynamic": wide(transaction_staged_sql(False), live=False),
    "order_report_order_total": layered_report(False),
    "order_report_clamped": layered_report(True),
    "refund_report": REFUND_REPORT,
    "payments_view": PAYMENTS_VIEW_REPEATED,
    "payments_view_counted": PAYMENTS_VIEW,
    "payments_view_repeated": PAYMENTS_VIEW_REPEATED,
    "staging_run": " UNION ALL ".join(map(staged_counts, SNAPSHOT_COLUMNS)),
    "order_report_from_stage": f"WITH {ORDER_CURRENT} {FINAL}",
    "report_subset": f'WITH {ORDER_CURRENT} SELECT r.* EXCLUDE (item_key) FROM report r JOIN {IDS} i ON i.order_number = try_cast(r."Order Id" as bigint)',
    "check_unique_line_items": f'WITH {ORDER_CURRENT} SELECT count(*) AS n_rows, count(DISTINCT "Line Item ID") AS n_keys FROM report',
    "check_order_coverage": f"""SELECT 'orders' AS stage, count(DISTINCT Id) AS n_keys FROM m_Orders
  UNION ALL SELECT 'items', count(DISTINCT OrderId) FROM m_OrderItems oi WHERE {NO_ROOTS}
  UNION ALL SELECT 'lines', count(DISTINCT oi.OrderId) FROM m_OrderItems oi JOIN m_Orders o ON o.Id = oi.OrderId WHERE {NO_ROOTS}""",
    "check_expected_missing": f"SELECT OrderNumber AS order_number FROM m_Orders o WHERE NOT EXISTS (SELECT 1 FROM m_OrderItems oi WHERE oi.OrderId = o.Id AND {NO_ROOTS})",
    "check_step_spot": f"""SELECT stage, order_id, count(*) AS n_rows FROM (SELECT 'orders' AS stage, Id AS order_id FROM m_Orders
  UNION ALL SELECT 'items', OrderId FROM m_OrderItems UNION ALL SELECT 'lines', OrderId FROM m_OrderItems oi WHERE {NO_ROOTS}) s WHERE order_id = '42' GROUP BY stage, order_id""",
}
SQL["union_positional"] = SQL["union_payment_refund"]


def oracle(name: str) -> str:
    """Statement of one query with the model tables it names in front."""
    body = SQL[name]
    used = [t for t in MODEL if re.search(rf"\bm_{t}\b", body)]
    return with_model(used, body) if used else body
