import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rentledger.operators import aggregates as ag
from rentledger.operators import checks as ck
from rentledger.operators import controls as co
from rentledger.operators import filters as fi
from rentledger.operators import joins as jo
from rentledger.operators import projection as pr
from rentledger.operators import sets as se
from rentledger.operators import windows as wi
from rentledger.plans import order_report, transaction_report
from rentledger.sources import catalog as ca
from rentledger.sources import schema as sch
from rentledger.sources import snapshot as sn

EVENTS = "Id string, OrderItemId string, CreatedOn timestamp_ntz, RefundedTotalAmount decimal(12,2), TotalAmount decimal(12,2)"


def ts(text):
    import datetime as dt

    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("e2", "i1", ts("2024-01-02"), D("5.00"), D("20.00")),
        ("e1", "i1", ts("2024-01-02"), D("1.00"), None),  # same time, wins by id, NULL value is kept
        ("e3", "i1", ts("2024-01-01"), None, D("99.00")),  # unknown amount: no refund event
        ("e4", "i2", None, D("2.00"), D("7.00")),  # unknown time comes last
        ("e5", "i2", ts("2024-03-01"), D("3.00"), D("8.00")),
        ("e6", "i3", ts("2024-03-01"), D("0.00"), D("9.00")),
    ]
    return spark.createDataFrame(rows, EVENTS)


def sets(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_alacarte_filter_drops_unknown_flag_without_parent(spark):
    rows = [(1, None, True), (2, None, False), (3, None, None), (4, "p", True), (5, "p", None)]
    df = spark.createDataFrame(rows, "id int, parent string, flag boolean")
    assert [r.id for r in fi.drop_alacarte_roots(df, "parent", "flag").orderBy("id").collect()] == [2, 4, 5]


def test_refund_totals_and_first_event(events):
    assert sets(ag.refund_totals(events)) == [("i1", D("6.00")), ("i2", D("5.00"))]
    first = ag.first_by(fi.positive(events, "RefundedTotalAmount"), "OrderItemId", {"TotalAmount": "before", "Id": "id"})
    assert sets(first) == [("i1", None, "e1"), ("i2", D("8.00"), "e5")]
    kept = wi.earliest(fi.positive(events, "RefundedTotalAmount"), ["OrderItemId"])
    assert sorted(r.Id for r in kept.collect()) == ["e1", "e5"]


def test_rank_breaks_ties_and_puts_unknown_times_last(events):
    ranked = wi.rank_events(fi.positive(events, "RefundedTotalAmount"), ["OrderItemId"])
    assert sets(ranked.select("Id", "rn")) == [("e1", 1), ("e2", 2), ("e4", 2), ("e5", 1)]


def test_coupon_lists(spark):
    used = spark.createDataFrame([("o", "c2", "i1"), ("o", "c1", "i1"), ("o", "c1", "i1"), ("o", "c9", "i2"), ("o", "c3", "i3")], "OrderId string, CouponId string, OrderItemId string")
    codes = spark.createDataFrame([("c1", "B"), ("c2", "A"), ("c3", None)], "Id string, CouponCode string")
    assert sets(ag.coupon_codes(used, codes)) == [("i1", "A,B,B"), ("i3", None)]
    assert sets(ag.coupon_codes(used, codes, how="left")) == [("i1", "A,B,B"), ("i2", None), ("i3", None)]


def test_refunds_of_unknown_payments_are_left_out(spark):
    refunds = spark.createDataFrame([("p1", D("1.00"), D("0.1050")), ("p1", D("2.00"), None), ("x", D("4.00"), D("1.0000"))], "PaymentTransactionId string, Amount decimal(12,2), RefundedProcessingFee decimal(14,4)")
    payments = spark.createDataFrame([("p1",), ("p2",)], "Id string")
    assert sets(ag.payment_refunds(refunds, payments)) == [("p1", D("3.00"), D("0.1050"))]
    assert sets(ag.payment_refunds(refunds, round_to_cents=True)) == [("p1", D("3.00"), D("0.11")), ("x", D("4.00"), D("1.00"))]


def attrs(spark, rows, key="order_id"):
    return spark.createDataFrame(rows, f"{key} string, control_name string, control_value string")


def test_pivot_of_awkward_names(spark):
    rows = [("1", "a, b", "y"), ("1", "a, b", "x"), ("1", "a, b", "x"), ("1", "50 %", None), ("2", "it's", "z"), ("2", "50 %", "q")]
    out = co.pivot_controls(attrs(spark, rows), "order_id")
    assert out.columns == ["order_id", "50 %", "a, b", "it's"]
    assert sets(out) == [("1", None, "x, x, y", None), ("2", "q", None, "z")]


def test_pivot_without_attributes_has_only_the_key(spark):
    out = co.pivot_controls(attrs(spark, []), "order_id")
    assert out.columns == ["order_id"] and out.count() == 0


def test_quotes_merge_names(spark):
    cleaned = co.cleaned_names(attrs(spark, [("1", 'say "hi"', "a"), ("1", "say hi", "b")]))
    assert sets(co.pivot_controls(cleaned, "order_id")) == [("1", "a, b")]


def test_names_shared_by_scopes_get_their_scope():
    names = co.unique_names({"order": ["Color", "Tag"], "product": ["color"]}, ["User"])
    assert names == {"order": {"Color": "Color (order)", "Tag": "Tag"}, "product": {"color": "color (product)"}}
    assert co.unique_names({"order": ["User"]}, ["user"]) == {"order": {"User": "User (order)"}}


def test_override_hides_all_inherited_rows(spark):
    own = attrs(spark, [("i1", "A", "own")], "order_item_id")
    inherited = attrs(spark, [("i1", "B", "old"), ("i2", "B", "kept")], "order_item_id")
    assert sets(co.override(own, inherited, "order_item_id")) == [("i1", "A", "own"), ("i2", "B", "kept")]


def as_dicts(df, key, column):
    return {r[key]: None if r[column] is None else {e["name"]: e["value"] for e in r[column]} for r in df.collect()}


def test_attribute_entries_merge_values_and_keep_names_without_any(spark):
    rows = [("1", "a, b", "y"), ("1", "a, b", "x"), ("1", "a, b", "x"), ("1", "50 %", None), ("2", None, "lost"), ("3", "it's", "z")]
    maps = co.attribute_map(attrs(spark, rows), "order_id", "m")
    assert as_dicts(maps, "order_id", "m") == {"1": {"50 %": None, "a, b": "x, x, y"}, "2": {}, "3": {"it's": "z"}}
    assert co.listed(co.map_names(maps, {"order": "m"})) == {"order": ["50 %", "a, b", "it's"]}
    out = co.expand_maps(maps, {"order": "m"}, {"order": ["50 %", "a, b", "no such"]})
    assert out.columns == ["order_id", "50 %", "a, b", "no such"]
    assert sets(out) == [("1", None, "x, x, y", None), ("2", None, None, None), ("3", None, None, None)]
    assert co.expand_maps(maps, {"order": "m"}, {}).columns == ["order_id"]


def test_overrides_of_all_scopes_in_one_read(spark):
    option = "DynamicControlOptionId string, control_name string, control_value string"
    product = spark.createDataFrame([("p1", "Size", "XL"), ("p2", "Size", None), ("p3", "Kind", "bike")], option)
    place = spark.createDataFrame([("l1", "Zone", "A"), ("p1", "Zone", "B")], option)
    rows = [("i1", "p1", 0), ("i1", "p1", 1), ("i1", "p3", 0), ("i1", "p3", 0), ("i2", "l1", 1), ("i3", "p2", 0), ("i4", "gone", 0)]
    overrides = spark.createDataFrame(rows, "OrderItemId string, DynamicControlOptionId string, DynamicControlType int")
    own = co.override_maps(overrides, {"product": (0, product), "location": (1, place)})
    assert as_dicts(own, "order_item_id", "_own_product") == {"i1": {"Size": "XL", "Kind": "bike, bike"}, "i2": None, "i3": {"Size": None}}
    assert as_dicts(own, "order_item_id", "_own_location") == {"i1": {"Zone": "B"}, "i2": {"Zone": "A"}, "i3": None}


def test_attributes_of_unknown_products_reach_their_lines(spark):
    products = spark.createDataFrame([("p1", "One"), ("p2", "Two")], "Id string, Name string")
    maps = co.attribute_map(attrs(spark, [("p1", "A", "1"), ("p9", "A", "9")], "product_id"), "product_id", "m")
    lines = spark.createDataFrame([("p1",), ("p2",), ("p9",), (None,)], "product_id string")
    out = jo.enrich(lines, co.with_map(products, "Id", maps, "product_id"), "product_id", "Id", {"name": "Name", "m": "m"})
    assert as_dicts(out, "product_id", "m") == {"p1": {"A": "1"}, "p2": None, "p9": {"A": "9"}, None: None}


def test_entities_in_use_by_counting(spark):
    items = spark.createDataFrame([("i1", "p1"), ("i2", "p1"), ("i3", "p2"), ("i4", None)], "order_item_id string, product_id string")
    own = spark.createDataFrame([("i1",), ("i3",), ("i3",), ("ix",)], "order_item_id string")
    assert sets(co.entities_in_use(items, own, "product_id").where("product_id IS NOT NULL")) == [("p1",)]
    names = co.scope_names(items, attrs(spark, [("i1", "Own", "x"), ("i3", None, "x")], "order_item_id"), attrs(spark, [("p1", "A", "1"), ("p2", "B", "2")], "product_id"), "product_id")
    assert sets(names) == [("A",), ("Own",)]
    assert sets(co.numbered_names({"product": names, "order": names.limit(0)})) == [("product", 1, "A"), ("product", 2, "Own")]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, None, D("2.50"))], "a int, `b.c` string, `d %` decimal(10,2)")
    assert pr.move_column(df, "d %", 1).columns == ["d %", "a", "b.c"]
    assert pr.move_column(df, "d %", 9).columns == ["a", "b.c", "d %"]
    assert pr.move_column(df, "none", 1).columns == df.columns
    assert pr.blank_nulls(df).first() == ("1", "", "2.50")
    assert pr.drop_keys(df, ["a", "unknown"]).columns == ["b.c", "d %"]
    assert pr.label(df, [("b.c", "B"), (F.col("a") + 1, "A?")]).columns == ["B", "A?"]


def test_restrict_and_missing(spark):
    report = spark.createDataFrame([("1",), ("x",), ("3",)], "`Order Id` string")
    ids = ca.id_table(spark, [1, 2])
    assert sets(jo.restrict(report, ids)) == [("1",)]
    assert sets(ck.missing_ids(report, ids)) == [(2,)]


def test_payment_links(spark):
    orders = spark.createDataFrame([("o1", "p1"), ("o2", None)], "order_id string, payment_transaction_id string")
    pays = spark.createDataFrame([("p1", "o9", 1), ("p2", "o1", 2), ("p3", "o1", 3)], "payment_transaction_id string, order_id string, amount int")
    assert sets(jo.attach_payment(orders, pays, "id").select("order_id", "amount")) == [("o1", 1), ("o2", None)]
    assert sets(jo.attach_payment(orders, pays, "order").select("order_id", "amount")) == [("o1", 2), ("o1", 3), ("o2", None)]
    with pytest.raises(ValueError):
        jo.attach_payment(orders, pays, "x")


def test_rules_that_do_not_apply_are_errors():
    with pytest.raises(TypeError):
        order_report({}, variant="clamped", dynamic=True)
    with pytest.raises(TypeError):
        order_report({}, variant="order_total", payment_link="order")
    with pytest.raises(TypeError):
        transaction_report({}, refunded="sum")


def test_history_can_be_reduced_to_the_latest_row(spark):
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    rows = [("h1", "o1", ts("2024-01-01")), ("h2", "o1", ts("2024-02-01")), ("h3", "o1", ts("2024-02-01"))]
    history = spark.createDataFrame(rows, "order_history_id string, order_id string, created_on_oh timestamp_ntz")
    assert jo.attach_history(orders, history).count() == 4
    assert sets(jo.attach_history(orders, history, dedupe=True).select("order_id", "order_history_id")) == [("o1", "h3"), ("o2", None)]


def test_split_and_stack(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 0)], "k string, n int")
    refunds, payments = fi.split_by_refund_id(df, "n", None)
    assert (refunds.count(), payments.count()) == (2, 1)
    refunds, payments = fi.split_by_refund_id(df, "n", 0)
    assert (sets(refunds), sets(payments)) == ([("a", 5)], [("c", 0)])
    both = se.stack(df, df.select("n", "k"), {"k": "string", "n": "bigint"})
    assert both.count() == 6 and both.dtypes == [("k", "string"), ("n", "bigint")]


def test_csv_keeps_quotes_breaks_and_nulls(spark, tmp_path):
    rows = [("a", 'say "x", ok', None), ("b", "two\nlines", ""), (None, "NULLs", "z")]
    df = spark.createDataFrame(rows, "k string, t string, n string")
    sn.write_csv(df, str(tmp_path / "csv"))
    assert sets(sn.read_csv(spark, str(tmp_path / "csv"), df.schema)) == sorted(rows, key=repr)


def test_rerun_replaces_and_stage_is_read_back(spark, tmp_path, monkeypatch):
    df = spark.range(5)
    for _ in range(2):
        sn.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    monkeypatch.setattr(sn, "stage_root", lambda _: None)
    with pytest.raises(ValueError):
        sn.checkpoint_stage(df)
    monkeypatch.setattr(sn, "stage_root", lambda _: str(tmp_path / "shared"))
    staged = sn.checkpoint_stage(df, name="ids")
    assert staged.count() == 5 and "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert os.listdir(tmp_path / "shared")[0].startswith("ids-")


def test_sources_and_names(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "DynamicControls.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "Products.parquet"))
    found = ca.load_source(spark, "products", ["DynamicControls", "Products"], {"path": str(tmp_path)})
    named = ca.register(found, "products")
    assert sorted(named) == ["ProductDynamicControls", "Products"]
    assert set(sch.SNAPSHOT_COLUMNS) >= {"Orders", "PaymentRefund", "LocationDynamicControlValues"} and len(sch.SNAPSHOT_COLUMNS) == 24
    pruned = sn.snapshot(spark.createDataFrame([(0.1, "x", 1)], "m double, t string, n int"), ["t", "m"], exact_money=True)
    assert pruned.dtypes == [("t", "string"), ("m", "decimal(24,10)")]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    assert ck.check_unique(df, "k").first() == (3, 2)
    assert sets(ck.coverage({"all": df, "some": df.filter("n = 1")}, "k")) == [("all", 2), ("some", 1)]
    assert {n: d.count() for n, d in ck.trace({"all": df, "some": df.filter("n = 3")}, "k", "a").items()} == {"all": 2, "some": 0}
