"""One query per operator and report, over whole tables. ``m`` holds the model tables of one data folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger import configure
from rentledger.functions import formulas as fx
from rentledger.functions import money as mo
from rentledger.functions import scalar as sc
from rentledger.functions import timefmt as tf
from rentledger.operators import aggregates as ag
from rentledger.operators import checks as ck
from rentledger.operators import controls as co
from rentledger.operators import filters as fi
from rentledger.operators import joins as jo
from rentledger.operators import projection as pr
from rentledger.operators import sets as se
from rentledger.operators import windows as wi
from rentledger.plans import layered, model, order_report, payments_view, refund_report, transaction_report
from rentledger.sources import catalog as ca
from rentledger.sources import schema as sch
from rentledger.sources import snapshot as sn
from rentledger.sources import staging as st
from rentledger.sources import versions as ve

from .model_sql import ModelTables

c = F.col
QUERIES: dict[str, Callable[[ModelTables], DataFrame]] = {}


def query(fn: Callable[[ModelTables], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def bound(fn: Callable[[ModelTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ModelTables(configure(spark), sf_dir, write_items=True))

    return run


def scratch(m: ModelTables) -> str:
    """New folder for written results below a folder that driver and executors share."""
    root = sn.stage_root(m.spark) or m.spark.conf.get("spark.sql.warehouse.dir")
    return os.path.join(root, f"out-{uuid.uuid4().hex}")


def items(m: ModelTables) -> DataFrame:
    return model.items_of(m)


def lines(m: ModelTables) -> DataFrame:
    """Items with their order's payment and refund figures, the inputs of the report formulas."""
    rows = jo.join_agg(model.items_of(m), ag.refund_totals(m["OrderItemsHistory"], "refunded_amount"), "order_item_id")
    return jo.lines_from_items(rows, model.order_header(m))


def events(m: ModelTables) -> DataFrame:
    names = {"Id": "event_id", "OrderItemId": "order_item_id", "CreatedOn": "event_time", "RefundedTotalAmount": "amount"}
    return fi.positive(pr.rename_project(m["OrderItemsHistory"], names), "amount")


def asked_for(m: ModelTables) -> DataFrame:
    """The orders that the subset queries are asked for, by a rule on the orders table."""
    return m["Orders"].select(c("OrderNumber").alias("order_number")).filter(c("order_number") % 7 == 3)


def text_time(name: str):
    return F.date_format(c(name), "yyyy-MM-dd HH:mm:ss").alias(name)


# --- scans, sources, sinks ------------------------------------------------------------------------


@query
def scan_catalog(m):
    names = ["orders", "lineitem", "customer", "part", "supplier", "nation", "region"]
    tables = ca.load_source(m.spark, "star", names, {"format": "parquet", "path": m.folder})
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    out = counts[0]
    for nxt in counts[1:]:
        out = se.stack(out, nxt)
    return out


@query
def snapshot_pruned(m):
    timed = {"CreatedOn", "ModifiedOn", "StartDate", "EndDate"}
    kept = sn.snapshot(m["OrderItems"], sch.SNAPSHOT_COLUMNS["OrderItems"])
    return kept.select([text_time(n) if n in timed else c(n) for n in kept.columns])


@query
def snapshot_full(m):
    return sn.snapshot(m["customer"])


@query
def disambiguate_names(m):
    named = {}
    for domain, prefix in sch.SYSTEM_PREFIX.items():
        named |= ca.register({"DynamicControlOptions": m[f"{prefix}DynamicControlOptions"]}, domain)
    counts = [df.groupBy("DynamicControlId").agg(F.count(F.lit(1)).alias("n_options")).select(F.lit(n).alias("table_name"), "DynamicControlId", "n_options") for n, df in named.items()]
    return se.stack(se.stack(counts[0], counts[1]), counts[2])


@query
def materialize_stage(m):
    staged = sn.checkpoint_stage(fi.drop_alacarte_roots(items(m), "parent_order_item_id", "is_a_la_carte"), scratch(m))
    return staged.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("total_amount").cast(mo.MONEY).alias("amount"))


@query
def overwrite_idempotent(m):
    path = scratch(m)
    table = m["Reservations"].drop("CreatedOn", "ModifiedOn")
    ve.write_versioned(table, path)
    ve.write_versioned(table, path)
    return ve.read_versioned(m.spark, path)


@query
def staging_run(m):
    """All 24 tables from double money into snapshots, with the counts that were observed while writing."""
    root = scratch(m)
    doubles = {n: m[n].withColumns({c: F.col(c).cast("double") for c, t in m[n].dtypes if t.startswith("decimal")}) for n in sch.SNAPSHOT_COLUMNS}
    return st.count_table(m.spark, st.stage_all(doubles, root))


@query
def order_report_from_stage(m):
    """The order report over staged snapshots of the tables it needs."""
    root = scratch(m)
    names = ["Orders", "OrderItems", "OrderItemsHistory", "Reservations", "OrderCoupons", "Coupons", "Products", "Locations", "Users", "Partners", "PaymentTransactions", "PaymentRefund"]
    st.stage_all(m, root, {n: sch.SNAPSHOT_COLUMNS[n] for n in names})
    return order_report(st.staged_tables(m.spark, root, names))


@query
def named_view(m):
    ca.register_view(payments_view(m, repeat_refunds=True), "rentledger_payments_view")
    return m.spark.table("rentledger_payments_view").select("order_id", "order_item_id", "payment_transaction_id", "paid_amount", "location_name", "site_name")


@query
def literal_table(m):
    ids = ca.id_table(m.spark, list(range(500000000000, 500000000600, 7)))
    listed = ids.select("order_number", F.lit(True).alias("listed"))
    orders = m["Orders"].select(c("OrderNumber").alias("order_number"))
    return orders.join(listed, "order_number", "left").select("order_number", F.coalesce("listed", F.lit(False)).alias("listed"))


@query
def report_sink(m):
    path = scratch(m)
    sn.write_report(order_report(m), path, versioned=True)
    return pr.label(ve.read_versioned(m.spark, path), [("Line Item ID", "line_item"), ("Total Collected", "total_collected"), ("Order Amount", "order_amount")])


@query
def csv_report_io(m):
    path = scratch(m)
    out = m["PaymentTransactions"].select("Id", "Source", "PaymentType", F.concat(F.lit('say "'), "Status", F.lit('",\nok\n\n"')).alias("Note"), c("Amount").cast("string").alias("Amount"))
    sn.write_csv(out, path)
    # Small splits, so that files are cut inside fields at any scale.
    return sn.read_csv(m.spark, path, "Id string, Source string, PaymentType string, Note string, Amount string", split_bytes=1 << 18)


# --- projections, filters -------------------------------------------------------------------------


@query
def rename_project(m):
    names = {k: v for k, v in layered.CLEAN_COLUMNS["OrderItems"].items() if v not in ("created_on_items", "start_date", "end_date")}
    return pr.rename_project(m["OrderItems"], names)


@query
def label_project(m):
    return pr.label(items(m), [("order_item_id", "Line Item Id"), (mo.money(c("tip")), "Gratuity"), ("sales_tax", "Tax"), ("partner_id", "PartnerId")])


@query
def carry_forward_star(m):
    doubled = pr.extend(m["OrderHistory"].drop("CreatedOn", "ModifiedOn"), has_refund_order=c("RefundOrderNumber").isNotNull())
    return pr.extend(doubled, twice=(c("RefundedTotal") * 2).cast(mo.MONEY))


@query
def constant_column(m):
    return items(m).select("order_item_id", sc.const("Payment").alias("transaction_type"), sc.const("").alias("tax_counties"), sc.const(None).alias("refund_order"), sc.const(0, "bigint").alias("refund_no"))


@query
def filter_root_alacarte(m):
    return fi.drop_alacarte_roots(items(m), "parent_order_item_id", "is_a_la_carte").select("order_item_id", "order_id")


@query
def filter_positive_refund(m):
    return fi.positive(m["OrderItemsHistory"], "RefundedTotalAmount").select("Id", "OrderItemId", "RefundedTotalAmount")


@query
def filter_has_payment(m):
    return fi.require(m["Orders"], "PaymentTransactionId").select("Id", "PaymentTransactionId")


@query
def filter_exported_controls(m):
    rows = co.resolve(m["OrderDynamicControlValues"], m["OrderDynamicControlOptions"], fi.exported(m["OrderDynamicControls"]), "OrderId", "order_id")
    return rows.select("order_id", "control_name", "control_value")


@query
def filter_live_values(m):
    return fi.live(m["ProductDynamicControlValues"]).select("ProductId", "DynamicControlOptionId")


@query
def filter_control_scope(m):
    product = fi.scope(m["OrderItemDynamicControls"], "DynamicControlType", fi.PRODUCT_SCOPE)
    location = fi.scope(m["OrderItemDynamicControls"], "DynamicControlType", fi.LOCATION_SCOPE)
    both = se.stack(product.withColumn("scope", F.lit("product")), location.withColumn("scope", F.lit("location")))
    return both.select("Id", "OrderItemId", "DynamicControlOptionId", "scope")


@query
def filter_point_lookup(m):
    found = fi.lookup(m["Orders"], "OrderNumber", 100000000042)
    return items(m).join(found.select(c("Id").alias("order_id"), "OrderNumber"), "order_id").select("order_item_id", "OrderNumber", "total_amount")


@query
def filter_refund_id_null(m):
    rows = m["OrderHistory"].select("Id", "RefundOrderNumber")
    with_id, without_id = fi.split_by_refund_id(rows, "RefundOrderNumber", None)
    zeroed = rows.withColumn("RefundOrderNumber", F.coalesce("RefundOrderNumber", F.lit(0)))
    refunds, payments = fi.split_by_refund_id(zeroed, "RefundOrderNumber", 0)
    parts = {"null/refund": with_id, "null/payment": without_id, "zero/refund": refunds, "zero/payment": payments}
    out = None
    for name, df in parts.items():
        part = df.select("Id", F.lit(name).alias("part"))
        out = part if out is None else se.stack(out, part)
    return out


@query
def drop_helper_columns(m):
    return pr.drop_keys(m["PaymentRefund"].drop("CreatedOn", "ModifiedOn"), ["PaymentTransactionId", "order_item_id_p"])


# --- joins ----------------------------------------------------------------------------------------


def orders_model(m):
    return model.model(m, "Orders", model.ORDER_COLUMNS)


@query
def left_join_chain_base(m):
    rows = jo.base_lines(orders_model(m), m["Reservations"], items(m))
    return rows.select("order_id", "order_number", "reservation_code", "order_item_id", "total_amount")


@query
def inner_join_item_first(m):
    return jo.lines_from_items(items(m), orders_model(m)).select("order_item_id", "order_id", "order_number", "order_total")


@query
def dimension_enrich(m):
    rows = jo.enrich(items(m), m["Products"], "product_id", "Id", {"product_name": "Name"})
    rows = jo.enrich(rows, m["Partners"], "partner_id", "Id", {"partner_name": "Name"})
    return rows.select("order_item_id", "product_name", "partner_name")


@query
def role_playing_self_dim(m):
    rows = jo.enrich(items(m), m["Locations"], "location_id", "Id", {"location_name": "Name"})
    rows = jo.enrich(rows, m["Locations"], "site_id", "Id", {"site_name": "Name"})
    return rows.select("order_item_id", "location_name", "site_name")


def payments_model(m):
    return model.model(m, "PaymentTransactions", model.PAYMENT_COLUMNS).withColumnRenamed("payment_id", "payment_transaction_id")


@query
def payment_by_order(m):
    return jo.attach_payment(orders_model(m), payments_model(m), "order").select("order_id", "payment_transaction_id", "paid_amount", "payment_source")


@query
def payment_by_id(m):
    return jo.attach_payment(orders_model(m), payments_model(m), "id").select("order_id", "payment_transaction_id", "paid_amount", "payment_source")


@query
def join_preaggregated(m):
    rows = jo.join_agg(items(m), ag.refund_totals(m["OrderItemsHistory"]), "order_item_id", {"sum_refunded": F.lit(0).cast(mo.MONEY)})
    return rows.select("order_item_id", "total_amount", c("sum_refunded").cast(mo.MONEY).alias("sum_refunded"))


@query
def join_unaggregated_refund(m):
    refunds = pr.rename_project(m["PaymentRefund"], {"PaymentTransactionId": "payment_transaction_id", "Amount": "refund_amount", "Id": "refund_id"})
    return jo.join_raw(payments_model(m), refunds, "payment_transaction_id").select("payment_transaction_id", "order_id", "refund_id", "refund_amount")


@query
def join_ranked_first(m):
    ranked = wi.earliest(events(m), ["order_item_id"], "event_time", "event_id").withColumn("rn", F.lit(1))
    return jo.join_first(items(m), ranked, "order_item_id").select("order_item_id", "event_id", "amount", "total_amount")


@query
def inner_join_refund_events(m):
    base = items(m).select("order_item_id", "total_amount")
    first = wi.earliest(events(m), ["order_item_id"], "event_time", "event_id").withColumn("rn", F.lit(1))
    both = [jo.refund_lines(base, e, which).withColumn("which", F.lit(which)) for which, e in (("all", events(m)), ("first", first))]
    return se.stack(*[b.select("which", "order_item_id", "event_id", "amount", "total_amount") for b in both]).select("which", "order_item_id", "event_id", "amount", "total_amount")


@query
def join_order_history(m):
    names = {"Id": "order_history_id", "OrderId": "order_id", "RefundOrderNumber": "refund_order_number", "CreatedOn": "created_on_oh"}
    history = pr.rename_project(m["OrderHistory"], names)
    orders = orders_model(m).select("order_id", "order_number")
    raw = jo.attach_history(orders, history).withColumn("mode", F.lit("all"))
    latest = jo.attach_history(orders, history, dedupe=True).withColumn("mode", F.lit("latest"))
    return se.stack(raw, latest).select("mode", "order_id", "order_number", "order_history_id", "refund_order_number")


@query
def eav_resolve(m):
    return co.resolve(m["ProductDynamicControlValues"], m["ProductDynamicControlOptions"], m["ProductDynamicControls"], "ProductId", "product_id")


def product_rows(m):
    return model.scope_rows(m, "product")


@query
def eav_expand_to_items(m):
    return co.expand(product_rows(m)[1], items(m), "product_id")


@query
def anti_join_cte(m):
    own, inherited = product_rows(m)
    return jo.without(co.expand(inherited, items(m), "product_id"), own, ["order_item_id"])


@query
def anti_join_correlated(m):
    own, _ = model.scope_rows(m, "location")
    return jo.without(items(m).select("order_item_id", "location_id"), own.select("order_item_id"), ["order_item_id"])


@query
def semi_join_in(m):
    web = fi.lookup(m["PaymentTransactions"], "Source", sc.WEB_SOURCE).select(c("OrderId").alias("order_id"))
    return jo.within(orders_model(m), web, ["order_id"]).select("order_id", "order_number")


@query
def join_expected_ids(m):
    report = pr.label(orders_model(m), [(sc.text(c("order_number")), "Order Id"), ("order_total", "order_total")])
    return jo.restrict(report, asked_for(m)).withColumnRenamed("Order Id", "order_number")


@query
def join_dynamic_columns(m):
    stage = scratch(m)
    return model.widened(model.item_attributes(m, stage=stage), m, stage=stage)


# --- aggregations, windows, sorts, sets -----------------------------------------------------------


@query
def agg_refund_total_by_item(m):
    return ag.refund_totals(m["OrderItemsHistory"]).select("order_item_id", c("sum_refunded").cast(mo.MONEY).alias("sum_refunded"))


@query
def agg_first_by_time(m):
    kept = fi.positive(m["OrderItemsHistory"], "RefundedTotalAmount")
    return ag.first_by(kept, "OrderItemId", {"TotalAmount": "earliest_total_amount", "RefundedDiscount": "first_discount"})


@query
def agg_payment_refunds(m):
    raw = ag.payment_refunds(m["PaymentRefund"])
    rounded = ag.payment_refunds(m["PaymentRefund"], round_to_cents=True).withColumnsRenamed({"sum_total_refund_amount": "rounded_amount", "sum_refunded_processing_fee": "rounded_fee"})
    both = raw.withColumns({n: c(n).cast("decimal(24,4)") for n in raw.columns[1:]})
    return both.join(rounded, "payment_transaction_id")


@query
def agg_payment_refunds_joined(m):
    known = ag.payment_refunds(m["PaymentRefund"], m["PaymentTransactions"])
    return known.withColumns({n: c(n).cast("decimal(24,4)") for n in known.columns[1:]})


@query
def agg_coupon_list(m):
    return ag.coupon_codes(m["OrderCoupons"], m["Coupons"])


@query
def agg_coupon_list_left(m):
    return ag.coupon_codes(m["OrderCoupons"], m["Coupons"], how="left")


@query
def agg_control_values(m):
    attrs = model.order_attributes(m)
    return ag.merge_values(attrs, ["order_id", "control_name"], "control_value", "control_value")


@query
def distinct_rows(m):
    return ag.dedupe(m["OrderCoupons"])


@query
def distinct_controls(m):
    return co.numbered_names(model.names_in_use(m))


@query
def count_rows(m):
    tables = ["Orders", "OrderItems", "OrderItemsHistory", "PaymentRefund"]
    out = None
    for name in tables:
        part = ag.row_count(m[name], "n_rows").select(F.lit(name).alias("table_name"), "n_rows", (c("n_rows") == 0).alias("is_empty"))
        out = part if out is None else se.stack(out, part)
    return out


@query
def count_distinct_keys(m):
    return ag.key_counts(items(m), {"order_id": "n_orders", "order_item_id": "n_line_items"})


@query
def window_earliest_event(m):
    return wi.earliest(events(m), ["order_item_id"], "event_time", "event_id").select("order_item_id", "event_id", "amount", text_time("event_time"))


@query
def window_rank_all(m):
    return wi.rank_events(events(m).drop("amount"), ["order_item_id"], "event_time", "event_id", stage=scratch(m)).select("order_item_id", "event_id", "rn")


@query
def window_partition_sum(m):
    rows = wi.with_partition_sum(events(m), ["order_item_id"], "amount", "sum_amount")
    return rows.select("order_item_id", "event_id", "amount", c("sum_amount").cast(mo.MONEY).alias("sum_amount"))


@query
def sort_report(m):
    return se.sort_report(pr.label(items(m), [("order_item_id", "Line Item ID"), ("total_amount", "amount")]), "Line Item ID")


@query
def limit_preview(m):
    return se.preview(items(m).select("order_item_id", "order_id", "total_amount"), 50, ["total_amount", "order_item_id"])


STACK_SCHEMA = {"order_item_id": "string", "transaction_type": "string", "amount": mo.MONEY, "refund_order": "string"}


def stack_parts(m):
    payments = items(m).select("order_item_id", F.lit("Payment").alias("transaction_type"), c("total_amount").alias("amount"), sc.const(None).alias("refund_order"))
    refunds = events(m).select(F.lit("Refund").alias("transaction_type"), "order_item_id", (-c("amount")).alias("amount"), c("event_id").alias("refund_order"))
    return payments, refunds


@query
def union_payment_refund(m):
    return se.stack(*stack_parts(m), STACK_SCHEMA)


@query
def union_positional(m):
    payments, refunds = stack_parts(m)
    return se.stack(payments, refunds.select(payments.columns)).withColumn("amount", c("amount").cast(mo.MONEY))


@query
def union_override_scope(m):
    own, inherited = product_rows(m)
    return se.stack(own, jo.without(co.expand(inherited, items(m), "product_id"), own.select("order_item_id"), ["order_item_id"]))


# --- scalar functions -----------------------------------------------------------------------------


def item_fn(name: str, build):
    QUERIES[name] = lambda m: build(items(m)).select("order_item_id", "result")


item_fn("fn_coalesce_zero", lambda df: df.withColumn("result", mo.money(mo.zero(c("tip")))))
item_fn("fn_coalesce_blank", lambda df: df.withColumn("result", sc.blank(c("site_id"))))
item_fn("fn_nullif_safe_divide", lambda df: df.withColumn("result", mo.share(c("tip"), c("delivery_fee"), c("coupon_discount"))))
item_fn("fn_round2", lambda df: df.withColumn("result", mo.money((c("total_items") - 50000) * F.lit("0.125").cast("decimal(4,3)"))))
item_fn("fn_greatest_clamp", lambda df: df.withColumn("result", mo.money(mo.at_least(c("tip") - c("booking_fee"), F.lit(0).cast(mo.MONEY)))))
item_fn("fn_case_flag", lambda df: df.withColumn("result", sc.refunded_flag(mo.zero(c("coupon_discount")), c("is_refunded_source"))))
item_fn("fn_partner_id_text", lambda df: df.withColumn("result", sc.partner_text(c("partner_id"))))
item_fn("fn_bool_text_upper", lambda df: df.withColumn("result", sc.flag_text(c("is_refunded_source"))))
item_fn("fn_negate", lambda df: df.withColumn("result", mo.neg(c("discount"))))
item_fn("fn_cast_text", lambda df: df.withColumn("result", F.concat_ws("|", sc.text(mo.money(c("delivery_fee"))), sc.text(c("partner_id")))))
item_fn("fn_local_date", lambda df: df.withColumn("result", F.concat_ws("|", tf.local_date(c("created_on")), tf.local_date(c("created_on"), fmt=tf.MONTH_FIRST))))
item_fn("fn_local_time", lambda df: df.withColumn("result", tf.local_time(c("created_on"))))
item_fn("fn_double_shift_date", lambda df: df.withColumn("result", F.concat_ws("|", tf.double_shift(c("start_date")), tf.double_shift(c("start_date"), session_zone="UTC"))))
item_fn("fn_utc_roundtrip", lambda df: df.withColumn("result", tf.double_shift(c("created_on"), via_zone="UTC", session_zone="UTC", fmt=tf.MONTH_FIRST)))


@query
def fn_coalesce_default(m):
    return m["PaymentTransactions"].select("Id", sc.default(c("PaymentProviderName"), "Unknown").alias("result"))


@query
def fn_coalesce_priority(m):
    return model.with_dimensions(items(m), m).select("order_item_id", c("tax_percentage").cast("decimal(8,3)").alias("result"))


@query
def fn_case_pick_amount(m):
    picked = sc.actual_amount(mo.zero(c("refunded_amount")), c("booking_fee"), c("total_amount"))
    return lines(m).select("order_item_id", mo.money(picked).alias("result"))


@query
def fn_case_pick_history(m):
    rows = jo.join_agg(items(m), ag.first_by(fi.positive(m["OrderItemsHistory"], "RefundedTotalAmount"), "OrderItemId", {"Tip": "tip_before", "Total": "total_before", "RefundedTotalAmount": "first_refund"}).withColumnRenamed("OrderItemId", "order_item_id"), "order_item_id")
    refunded = mo.zero(c("first_refund"))
    return rows.select("order_item_id", sc.pick(refunded, c("tip"), c("tip_before")).alias("tip"), sc.pick(refunded, c("total_items"), c("total_before")).alias("total"))


@query
def fn_mask_user(m):
    return model.order_header(m).select("order_id", sc.mask_user(c("payment_source"), c("user_name")).alias("result"))


@query
def fn_concat_nullsafe(m):
    return m["Users"].select("Id", sc.full_name(c("FirstName"), c("LastName")).alias("result"))


def uuid_text(name: str):
    h = F.md5(c(name))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


@query
def fn_cast_uuid(m):
    raw = F.when(c("order_item_id").endswith("4"), F.lit("not-a-uuid")).otherwise(F.concat(F.lit(" "), F.upper(uuid_text("order_item_id"))))
    return items(m).select("order_item_id", sc.uuid(raw).alias("result"))


@query
def fn_cast_bigint(m):
    strict = sc.as_long(c("order_item_id")).alias("strict")
    tolerant = sc.as_long(F.coalesce("site_id", "product_id"), strict=False).alias("tolerant")
    return items(m).select("order_item_id", strict, tolerant)


@query
def fn_replace_quotes(m):
    return m["OrderDynamicControlValues"].join(co.exported_options(m["OrderDynamicControlOptions"], m["OrderDynamicControls"]), "DynamicControlOptionId").select("OrderId", "DynamicControlOptionId", sc.clean_name(c("control_name")).alias("result"))


# --- report formulas ------------------------------------------------------------------------------


def line_fn(name: str, build):
    QUERIES[name] = lambda m: lines(m).select("order_item_id", *[e.alias(n) for n, e in build().items()])


def create():
    return fx.create_fee(c("processing_fee"), c("total_amount"), c("paid_amount"))


def back():
    refunded = mo.zero(c("refunded_amount"))
    return fx.refund_fee(mo.zero(c("sum_refunded_processing_fee")), refunded, c("sum_total_refund_amount"))


def parts():
    return [mo.money(c(n)) for n in ("tip", "total_items", "booking_fee", "sales_tax", "delivery_fee")]


def clamped():
    cut = [mo.zero(c(n)) for n in ("tip", "coupon_discount", "discount")]
    return fx.final_subtotal(*cut, floor=F.lit(0).cast(mo.MONEY))


line_fn("final_subtotal", lambda: {"result": mo.money(fx.final_subtotal(c("total_items"), c("coupon_discount"), c("discount")))})
line_fn("final_subtotal_total_amount", lambda: {"result": mo.money(fx.final_subtotal(c("total_amount"), c("coupon_discount"), c("discount")))})
line_fn("final_subtotal_clamped", lambda: {"result": mo.money(clamped())})
line_fn("prorate_create_fee", lambda: {"result": create(), "filled": mo.zero(create())})
line_fn("prorate_refund_fee", lambda: {"result": back()})
line_fn("prorate_total_fee", lambda: {"result": fx.total_fee(mo.zero(create()), mo.zero(back()))})
line_fn("total_collected_order", lambda: {"result": fx.collected_order(*parts(), mo.zero(create()), mo.zero(back()))})
line_fn("total_collected_payment", lambda: {"result": fx.collected_payment(*parts(), mo.zero(create()))})


def refund_event_lines(m):
    rows = model.model(m, "OrderItemsHistory", {"Id": "event_id", "OrderItemId": "order_item_id", "RefundedTotalAmount": "event_amount", "RefundedTotal": "event_total", "RefundedCouponDiscount": "event_coupon", "RefundedDiscount": "event_discount", "RefundedTip": "event_tip", "RefundedBookingFee": "event_booking", "RefundedSalesTax": "event_tax", "RefundedDeliveryFee": "event_delivery"})
    return jo.refund_lines(lines(m), fi.positive(rows, "event_amount"))


def returned():
    return [mo.zero(c("sum_refunded_processing_fee")), c("event_amount"), mo.zero(c("sum_total_refund_amount"))]


@query
def total_collected_refund(m):
    net = mo.neg(fx.final_subtotal(c("event_total"), c("event_coupon"), c("event_discount")))
    out = fx.collected_refund(mo.neg(c("event_tip")), net, mo.neg(c("event_booking")), mo.neg(c("event_tax")), c("event_delivery"), fx.refund_share_unrounded(*returned()))
    return refund_event_lines(m).select("event_id", out.alias("result"))


@query
def refund_sign_rules(m):
    signed = fx.refund_signs(refund_event_lines(m), ["event_total", "event_tip", "event_booking", "event_tax"])
    return signed.select("event_id", "event_total", "event_coupon", "event_discount", "event_tip", "event_booking", "event_tax", "event_delivery")


@query
def refund_fee_signed(m):
    return refund_event_lines(m).select("event_id", fx.refund_fee_signed(*returned()).alias("result"))


def layered_fn(name: str, formula, names: list[str], outs: list[str]):
    def run(m):
        keys = ["order_id", "order_item_id", "payment_id", "refunded_processing_fee", "order_level_refund"]
        found = formula(*[c(n) for n in names])
        found = found if isinstance(found, tuple) else (found,)
        return layered.lines(m).select(*keys, *[e.alias(n) for n, e in zip(outs, found)])

    QUERIES[name] = run


_LEVEL = ["paid_amount", "order_level_refund", "refunded_processing_fee"]
_PART = ["total_amount_items", "total"]
layered_fn("prorate_by_order_total", fx.fees_by_order_total, ["processing_fee", "refunded_processing_fee", *_PART], ["create_fee", "refund_fee", "total_fee"])
layered_fn("prorate_booking_fee", fx.booking_share, ["booking_fee", *_PART], ["result"])
layered_fn("total_collected_order_level", fx.collected_level, _LEVEL, ["result"])
layered_fn("total_collected_prorated", fx.collected_share, [*_LEVEL, *_PART], ["result"])


# --- dynamic columns ------------------------------------------------------------------------------


@query
def scoped_override(m):
    own, inherited = model.scope_rows(m, "location")
    return co.override(own, co.expand(inherited, items(m), "location_id"), "order_item_id")


@query
def pivot_order_controls(m):
    return co.pivot_controls(model.order_attributes(m), "order_id")


@query
def pivot_product_controls(m):
    return model.pivot_by_item(m, "product", stage=scratch(m))


@query
def pivot_location_controls(m):
    return model.pivot_by_item(m, "location", stage=scratch(m))


@query
def pivot_empty_guard(m):
    hidden = fi.lookup(m["OrderDynamicControls"], "ShowInExport", False)
    none = co.resolve(m["OrderDynamicControlValues"], m["OrderDynamicControlOptions"], hidden, "OrderId", "order_id")
    pivoted = co.pivot_controls(none, "order_id")
    return orders_model(m).join(pivoted.withColumn("found", F.lit(True)), "order_id", "left").select("order_id", "found")


@query
def column_reorder(m):
    wide = model.pivot_by_item(m, "location", stage=scratch(m)).withColumn("item", c("order_item_id"))
    moved = pr.move_column(wide, "Tax Counties", 1)
    return moved.select("order_item_id", "Tax Counties", F.lit(moved.columns.index("Tax Counties") + 1).alias("ordinal"))


@query
def blank_all_nulls(m):
    return pr.blank_nulls(items(m).select("order_item_id", "site_id", mo.money(c("tip")).alias("tip"), "is_refunded_source", "partner_id"))


# --- whole reports --------------------------------------------------------------------------------

QUERIES["order_report"] = lambda m: order_report(m)
QUERIES["order_report_dynamic"] = lambda m: order_report(m, dynamic=True, stage=scratch(m))
QUERIES["transaction_report"] = lambda m: transaction_report(m)
QUERIES["transaction_report_dynamic"] = lambda m: transaction_report(m, dynamic=True, stage=scratch(m))
QUERIES["order_report_static"] = lambda m: order_report(m, "static")
QUERIES["order_report_staged"] = lambda m: order_report(m, "staged")
QUERIES["order_report_staged_dynamic"] = lambda m: order_report(m, "staged", dynamic=True, stage=scratch(m))
QUERIES["transaction_report_static"] = lambda m: transaction_report(m, "static")
QUERIES["transaction_report_staged"] = lambda m: transaction_report(m, "staged")
QUERIES["transaction_report_staged_dynamic"] = lambda m: transaction_report(m, "staged", dynamic=True, stage=scratch(m))


def plain_times(df: DataFrame) -> DataFrame:
    timed = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({n: F.date_format(pr.quoted(n), "yyyy-MM-dd HH:mm:ss") for n in timed})


QUERIES["order_report_order_total"] = lambda m: plain_times(order_report(m, "order_total"))
QUERIES["order_report_clamped"] = lambda m: plain_times(order_report(m, "clamped"))
QUERIES["refund_report"] = lambda m: plain_times(refund_report(m))
QUERIES["payments_view"] = lambda m: payments_view(m, repeat_refunds=True)
QUERIES["payments_view_counted"] = lambda m: payments_view(m)
QUERIES["payments_view_repeated"] = lambda m: payments_view(m, repeat_refunds=True)


@query
def report_subset(m):
    return order_report(model.restricted(m, asked_for(m), stage=scratch(m)))


# --- checks ---------------------------------------------------------------------------------------


@query
def check_unique_line_items(m):
    return ck.check_unique(order_report(m), "Line Item ID")


@query
def check_order_coverage(m):
    kept = fi.drop_alacarte_roots(items(m), "parent_order_item_id", "is_a_la_carte")
    stages = {"orders": orders_model(m), "items": kept, "lines": jo.lines_from_items(items(m), orders_model(m))}
    return ck.coverage(stages, "order_id")


@query
def check_expected_missing(m):
    report = pr.label(jo.lines_from_items(items(m), orders_model(m)), [(sc.text(c("order_number")), "Order Id")])
    numbers = m["Orders"].select(c("OrderNumber").alias("order_number"))
    return ck.missing_ids(report, numbers)


@query
def check_step_spot(m):
    stages = {"orders": orders_model(m), "items": items(m), "lines": jo.lines_from_items(items(m), orders_model(m))}
    traced = ck.trace(stages, "order_id", "42")
    out = None
    for name, df in traced.items():
        part = df.select(F.lit(name).alias("stage"), "order_id")
        out = part if out is None else se.stack(out, part)
    return out.groupBy("stage", "order_id").agg(F.count(F.lit(1)).alias("n_rows"))
