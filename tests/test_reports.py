"""Whole reports: invariants, variants and plan shape."""

import re
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rentledger.operators.controls import numbered_names
from rentledger.plans import order_report, order_total_report, payments_view, refund_report, transaction_report
from rentledger.plans.parts import ITEM_KEYS, Part, parts_of
from rentledger.plans.transaction_report import LABELS
from rentledger.plans.model import REFERENCES, attributes, items_of, names_in_use, restricted, with_dimensions, written
from rentledger.sources.schema import SNAPSHOT_COLUMNS
from rentledger.sources.snapshot import checkpoint_stage, snapshot, write_table
from workload.model_sql import MODEL, ModelTables
from workload.queries import QUERIES, bound

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def m(spark):
    return ModelTables(spark, FOLDER)


@pytest.fixture(scope="module")
def order_rows(m):
    return order_report(m).collect()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_report_invariants(order_rows):
    ids = [r["Line Item ID"] for r in order_rows]
    assert len(ids) == len(set(ids)) > 3000
    for r in order_rows:
        assert D(r["Total Line Item Payment Processor Fee"]) == D(r["Create Line Item Payment Processor Fee"]) - D(r["Refund Line Item Payment Processor Fee"])
        if r["Order Type"] == "Consumer Web":
            assert r["User"] == ""
        assert r["Refunded?"] in ("TRUE", "FALSE")
    assert len(order_rows[0]) == 34


def test_variants_agree_where_their_rules_do(m, order_rows):
    static = {r["Line Item Id"]: r for r in order_report(m, "static", payment_link="id").collect()}
    assert set(static) == {r["Line Item ID"] for r in order_rows}
    for r in order_rows:
        s = static[r["Line Item ID"]]
        for name in ("RID", "Order Id", "Product Name", "Location", "User", "Tax", "Booking Fee"):
            assert r[name] == s[name]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_row_of_the_given_tables_is_in_the_model(spark, folder):
    m = ModelTables(spark, f"/root/testdata/{folder}")
    ids = m["OrderItems"].agg(F.count("*"), F.countDistinct("Id")).first()
    assert ids[0] == ids[1] == m["lineitem"].count()
    assert m["Orders"].count() == m["orders"].count()
    assert m["Users"].count() == m["customer"].count()
    assert m["PaymentRefund"].count() == m["OrderItemsHistory"].count()
    assert m["OrderItemsHistory"].groupBy("OrderItemId").count().agg(F.max("count")).first()[0] == 3


def test_every_variant_runs_on_snapshots_of_double_money(m):
    tables = {}
    for name, columns in SNAPSHOT_COLUMNS.items():
        df = m[name]
        doubles = [F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]
        tables[name] = snapshot(df.select(*doubles), columns, exact_money=True)
    assert set(tables) < set(MODEL)
    for variant in ("current", "staged", "static", "order_total", "clamped"):
        assert order_report(tables, variant).count() == order_report(m, variant).count() > 0
    for variant in ("current", "staged", "static"):
        assert transaction_report(tables, variant).count() > 0
    assert refund_report(tables).count() > 0 and payments_view(tables).count() > 0


def test_fan_out_of_the_first_reports_is_an_option(m):
    lines = m["Orders"].alias("o").join(m["OrderItems"].alias("i"), F.expr("o.Id = i.OrderId"), "left")
    per_payment = lines.join(m["PaymentTransactions"].alias("p"), F.expr("o.Id = p.OrderId"), "left").count()
    assert refund_report(m).count() == order_report(m, "order_total").count() == per_payment
    assert refund_report(m, fan_out=True).count() > order_total_report(m, fan_out=True).count() > per_payment
    assert refund_report(m, fan_out=True).columns == refund_report(m).columns


def test_payment_link_of_the_current_transaction_report(m):
    by_id, by_order = (transaction_report(m, payment_link=x) for x in ("id", "order"))
    assert by_order.columns == by_id.columns and by_order.count() != by_id.count()


def test_unknown_variant(m):
    with pytest.raises(KeyError):
        order_report(m, "nope")
    with pytest.raises(KeyError):
        transaction_report(m, "nope")


def test_control_columns_can_be_given(m):
    names = {"order": ["Order Status"], "product": ["Size Class"], "location": ["Tax Counties"]}
    out = order_report(m, dynamic=True, control_columns=names)
    assert out.columns[17] == "Tax Counties"
    assert out.columns[-2:] == ["Order Status", "Size Class"]
    assert len(out.columns) == 36


def test_names_are_read_from_the_written_report(m, tmp_path, monkeypatch):
    """Names that only an unshown root or an order without lines has are columns too; nothing but the attribute tables runs before the report."""
    stage = str(tmp_path / "s")
    out = order_report(m, dynamic=True, stage=stage)
    written = m.spark.read.parquet(stage)
    assert {"_attrs_order", "_attrs_product", "_attrs_location", "_shown"} <= set(written.columns)
    assert written.where("NOT _shown").count() > 0 and out.count() == written.where("_shown").count() == order_report(m).count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    found = {s: [r.control_name for r in df.orderBy("control_name").collect()] for s, df in names_in_use(m).items()}
    same = order_report(m, dynamic=True, control_columns=found)
    assert same.columns == out.columns and same.exceptAll(out).count() == 0


def test_overrides_are_read_once(m):
    lines = plan_of(order_report(m, dynamic=True, control_columns={"product": ["Size Class"], "location": ["Tax Counties"], "order": []}))
    once = plan_of(m["OrderItemDynamicControls"])
    assert lines.count("PX-ECONOMY") == once.count("PX-ECONOMY") > 0


def test_lazy_names(m, spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-names", "no action")
    frame = numbered_names(names_in_use(m))
    assert not tracker.getJobIdsForGroup("lazy-names")
    assert frame.count() > 4 and tracker.getJobIdsForGroup("lazy-names")


@pytest.mark.parametrize("variant", ["static", "staged"])
def test_staged_transactions_read_the_items_once(m, variant, tmp_path, conf):
    conf("spark.sql.exchange.reuse", "false")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.debug.maxToStringFields", "200")
    tables = dict(m) | {n: m[n] for n in SNAPSHOT_COLUMNS}
    write_table(m["OrderItems"], str(tmp_path / "only_items"))
    tables["OrderItems"] = m.spark.read.parquet(str(tmp_path / "only_items"))
    plan = plan_of(transaction_report(tables, variant))
    assert sum("FileScan parquet" in line and "ParentOrderItemId" in line for line in plan.splitlines()) == 1


def test_report_of_some_orders(m, spark, tmp_path):
    """Restricted tables hold what hangs on the orders only, and the report is that part of the whole one."""
    wanted = [500000000000 + k for k in (1, 7, 32, 33, 34, 35, 39, 999_999_999)]
    ids = spark.createDataFrame([(i,) for i in [*wanted, 500000000007]], "order_number long")
    few = restricted(m, ids)
    orders = {r.Id for r in few["Orders"].collect()}
    assert 0 < len(orders) < 8
    for name, (key, _, _) in REFERENCES.items():
        whole = m[name]
        assert few[name].count() < whole.count() and few[name].columns[0] == key
    assert {r.OrderId for r in few["OrderItems"].collect()} <= orders
    numbers = [str(i) for i in wanted]
    for build in (order_report, transaction_report):
        part, whole = build(few), build(m).where(F.col("Order Id" if "Order Id" in build(m).columns else "Order ID").isin(numbers))
        assert part.count() > 0 and part.exceptAll(whole).count() == 0 and whole.exceptAll(part).count() == 0
    by_order = order_report(restricted(m, ids, payment_link="order"), payment_link="order")
    assert by_order.exceptAll(order_report(m, payment_link="order")).count() == 0 and by_order.count() > 0


def test_payments_view_counts_refunds(m):
    plain, repeated = payments_view(m), payments_view(m, repeat_refunds=True)
    assert plain.columns == [*repeated.columns, "refund_count"]
    assert plain.groupBy("order_id", "order_item_id", "payment_transaction_id").count().where("count > 1").count() == 0
    assert repeated.count() == plain.selectExpr("sum(greatest(coalesce(refund_count, 1), 1))").first()[0] > plain.count()


def test_payments_view_queries_repeat_rows_for_refunds(spark, m):
    """The registered views have every refund of a payment as a row of its own."""
    named, whole, counted = (bound(QUERIES[n])(spark, FOLDER) for n in ("named_view", "payments_view", "payments_view_counted"))
    repeated = counted.selectExpr("sum(greatest(coalesce(refund_count, 1), 1))").first()[0]
    assert named.count() == whole.count() == repeated > counted.count()


def test_transaction_rows(spark, m):
    rows = transaction_report(m)
    kinds = {r["Transaction Type"]: r["n"] for r in rows.groupBy("Transaction Type").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds["Payment"] > kinds["Refund"] > 500
    paid = rows.filter(F.col("Transaction Type") == "Payment")
    assert paid.count() == paid.select("Line Item ID").distinct().count()
    assert [c for c in rows.columns if c != "order_id_original"] == [shown for _, shown, _ in LABELS]


def test_no_cartesian_product_and_pruned_scans(m):
    for df in (order_report(m), transaction_report(m), order_report(m, dynamic=True)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    users = re.search(r"customer\.parquet.*?ReadSchema: struct<([^>]*)>", plan_of(order_report(m)), re.S).group(1)
    assert "c_acctbal" not in users


def test_lines_are_deduplicated_where_they_are(m, conf):
    """Without broadcasts: the distinct step sits on the item-id join with no exchange between."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.debug.maxToStringFields", "200")
    lines = plan_of(transaction_report(m)).splitlines()
    keyed = [i for i, x in enumerate(lines) if "HashAggregate(keys=[" in x and "rental_end" in x]
    assert keyed
    steps = [x for x in lines[keyed[-1] + 1 :] if re.search(r"Exchange|SortMergeJoin", x)]
    assert "SortMergeJoin [order_item_id" in steps[0] and "Inner" in steps[0]
    # Both inputs of that join are plain shuffles, which is what lets a hot item be split.
    depth = lines.index(steps[0])
    children = [x for x in lines[depth + 1 :] if "Exchange hashpartitioning(order_item_id" in x]
    assert len(children) >= 2


@pytest.mark.parametrize("report", [order_report, transaction_report])
def test_generated_methods_are_compiled(spark, m, conf, report):
    """The JVM doesn't compile methods above 8,000 bytes; the last stage of both reports had longer ones and was interpreted."""
    conf("spark.sql.adaptive.enabled", "false")
    stages = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(report(m)._jdf.queryExecution().executedPlan())
    assert 0 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000


def test_order_level_joins_come_before_the_lines(m, conf):
    """Without broadcasts: users meet the orders and products the items, so no whole line is shuffled for them."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    lines = plan_of(order_total_report(m)).splitlines()

    def below(key):
        at = next(i for i, x in enumerate(lines) if f"Exchange hashpartitioning({key}" in x)
        depth = lines[at].index("Exchange")
        end = next((i for i in range(at + 1, len(lines)) if re.search(r"[A-Z]", lines[i]).start() <= depth), len(lines))
        return "\n".join(lines[at:end])

    assert "AS sales_tax#" not in below("created_by") and "o_orderkey" not in below("product_id")


def test_written_dimensions_are_broadcast_by_their_size(m, conf, tmp_path):
    conf("spark.sql.adaptive.enabled", "false")
    attrs = written(attributes(m), m, str(tmp_path / "s"))
    plan = plan_of(with_dimensions(items_of(m, attrs), m, attrs=attrs))
    assert "hashpartitioning(location_id" not in plan and "hashpartitioning(product_id" not in plan


def test_items_of_a_query_are_numbered_once(spark):
    written_items = ModelTables(spark, FOLDER, write_items=True)
    for name in ("OrderItems", "OrderItemsHistory", "OrderCoupons", "OrderItemDynamicControls"):
        assert "Window" not in plan_of(written_items[name])


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).toString() for i in range(blocks.size()) if blocks.apply(i).toString().startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that are still there; they are removed in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_a_written_step_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    step = checkpoint_stage(spark.range(1000).repartition(4, "id"), str(tmp_path / "s"))
    assert not left_behind(spark, before) and step.count() == 1000


@pytest.fixture(scope="module")
def odd(m):
    """The tables with an item twice, once in another order, items, events, coupons and overrides without an id, and orders without items."""
    tables = dict(m) | {n: m[n] for n in SNAPSHOT_COLUMNS}
    items = m["OrderItems"]
    twice = items.where("Id LIKE '%1'").withColumn("OrderId", F.when(F.col("Id") < "3", F.lit("1")).otherwise(F.col("OrderId")))
    tables["OrderItems"] = items.unionAll(twice).unionAll(items.where("Id LIKE '%2'").withColumn("Id", F.lit(None).cast("string")))
    tables["Orders"] = m["Orders"].unionAll(m["Orders"].limit(2).withColumn("Id", F.when(F.col("Id") < "2", F.lit("alone"))))
    for name in ("OrderItemsHistory", "OrderCoupons", "OrderItemDynamicControls"):
        tables[name] = m[name].unionAll(m[name].where("OrderItemId LIKE '%2'").withColumn("OrderItemId", F.lit(None).cast("string")))
    return tables


def test_parts_hold_every_item_once(odd):
    for name, key in ITEM_KEYS.items():
        parts = [Part(odd, n, 3)[name] for n in range(3)]
        assert sorted(map(str, odd[name].select(key).collect())) == sorted(str(r) for p in parts for r in p.select(key).collect())
        assert all(p.count() > 0 for p in parts)
    assert Part(odd, 0, 3)["Orders"] is odd["Orders"]


def test_number_of_parts(spark, m, monkeypatch):
    n = m["OrderItems"].count()
    monkeypatch.setattr("rentledger.plans.parts.ITEMS_OF_A_PART", n - 1)
    assert parts_of(m) == 1  # too small to be counted
    monkeypatch.setattr("rentledger.plans.parts.SMALL_BYTES", 0)
    assert parts_of(m) == parts_of(m, dynamic=True) == 2
    other = {n: m[n] for n in ("OrderItems", "OrderItemsHistory")} | {"OrderCoupons": m["OrderCoupons"].withColumn("OrderItemId", F.col("OrderItemId").cast("bigint"))}
    assert parts_of(other) == 1  # equal ids could differ in their hash
    monkeypatch.setattr("rentledger.plans.parts.ITEMS_OF_A_PART", n)
    assert parts_of(m) == 1


@pytest.mark.parametrize(
    ("report", "variant", "dynamic"),
    [(order_report, "current", True), (transaction_report, "current", False), (transaction_report, "staged", True), (order_report, "clamped", False)],
)
def test_a_report_in_parts_is_the_same(spark, odd, tmp_path, report, variant, dynamic):
    """Written part by part, with no shuffle files left, and the same rows; before, a report kept the shuffle files of all of its lines."""
    whole = report(odd, variant, dynamic=dynamic)
    before = shuffle_files(spark)
    parted = report(odd, variant, dynamic=dynamic, parts=2, stage=str(tmp_path / "s"))
    if not dynamic:  # the names of a dynamic report are read in a query of its own
        assert not left_behind(spark, before)
    assert "Exchange" not in plan_of(parted) and parted.columns == whole.columns and parted.dtypes == whole.dtypes
    assert parted.exceptAll(whole).count() == 0 and whole.exceptAll(parted).count() == 0 and parted.count() > 3000
