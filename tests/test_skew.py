"""One key holds a third of all rows: results stay whole and the work is split."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rentledger.operators import aggregates as ag
from rentledger.operators import controls as co
from rentledger.operators import joins as jo
from rentledger.operators import windows as wi

N = 6000


@pytest.fixture(scope="module")
def hot(spark):
    """(key, id, time, amount); key ``hot`` has a third of the rows."""
    rnd = random.Random(7)
    rows = []
    for i in range(N):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(500)}"
        rows.append((key, i, rnd.randrange(0, 3 * 365 * 86400), rnd.randrange(1, 1000)))
    df = spark.createDataFrame(rows, "k string, id int, secs int, amount int")
    df = df.withColumn("t", (F.lit("2022-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("secs"))))
    return rows, df


def test_rank_of_a_hot_item(hot):
    rows, df = hot
    groups = defaultdict(list)
    for k, i, t, _ in rows:
        groups[k].append((t, i))
    want = {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)}
    ranked = wi.rank_events(df, ["k"], "t", "id")
    assert {r.id: r.rn for r in ranked.collect()} == want


def test_hot_item_is_ranked_in_several_tasks_and_read_once(spark, conf, hot, tmp_path):
    rows, df = hot
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    ranked = wi.rank_events(df.mapInArrow(seen, df.schema), ["k"], "t", "id", stage=str(tmp_path))
    assert len({r.rn for r in ranked.where("k = 'hot'").collect()}) == N / 3 and reads.value == N
    parts = Counter(r._part for r in spark.read.parquet(f"{tmp_path}/ranks").where("k = 'hot'").collect())
    assert len(parts) > 3 and max(parts.values()) < N / 3 / 2
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("when", ["2024-05-05 10:00:00", None])
def test_hot_item_with_all_events_in_one_second(spark, conf, hot, when):
    rows, df = hot
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    ids = defaultdict(list)
    for k, i, *_ in rows:
        ids[k].append(i)
    same = df.withColumn("k", F.nullif("k", F.lit("k1"))).withColumn("t", F.lit(when).cast("timestamp"))
    ranked = wi.rank_events(same, ["k"], "t", "id")
    assert {r.id: r.rn for r in ranked.collect()} == {i: n for group in ids.values() for n, i in enumerate(sorted(group), 1)}


def test_ranks_of_equal_rows_of_several_keys_and_of_no_rows(spark, conf):
    conf("spark.sql.shuffle.partitions", "5")
    df = spark.createDataFrame([("a", 1, 1)] * 5 + [("a", None, None)] * 2 + [(None, 2, None)], "k string, t int, id int")
    ranked = wi.rank_events(df, ["k"], "t", "id").collect()
    assert sorted(r.rn for r in ranked if r.k) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r.rn for r in ranked if r.k and r.t is None) == [6, 7] and [r.rn for r in ranked if not r.k] == [1]
    assert wi.rank_events(df.limit(0), ["k"], "t", "id").count() == 0
    pairs = spark.range(300).selectExpr("id % 2 AS a", "if(id % 3 = 0, null, 'x') AS b", "id div 7 AS t", "id")
    got = Counter((r.a, r.b, r.rn) for r in wi.rank_events(pairs, ["a", "b"], "t", "id").collect())
    assert got == Counter({(a, b, n): 1 for a in (0, 1) for b, many in ((None, 50), ("x", 100)) for n in range(1, many + 1)})


def test_sum_beside_each_row(hot):
    rows, df = hot
    sums = Counter()
    for k, _, _, a in rows:
        sums[k] += a
    out = wi.with_partition_sum(df, ["k"], "amount", "s")
    assert {r.id: r.s for r in out.collect()} == {i: sums[k] for k, i, _, _ in rows}
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_value_lists_gather_counts_not_rows(spark):
    rows = [("hot", f"v{i % 5}") for i in range(N)] + [("b", "x"), ("b", "w")]
    df = spark.createDataFrame(rows, "k string, v string")
    out = {r.k: r.merged for r in ag.merge_values(df, ["k"], "v", "merged").collect()}
    assert out["b"] == "w, x"
    assert Counter(out["hot"].split(", ")) == Counter(v for k, v in rows if k == "hot")


def test_earliest_limits_groups_before_the_shuffle(hot):
    _, df = hot
    plan = wi.earliest(df, ["k"], "t", "id")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in lines[exchange:])


def small_partitions(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.shuffle.partitions", "16")


@pytest.mark.parametrize("entity", ["product_id", "location_id"])
def test_hot_entity_of_a_pivot_is_split(spark, conf, hot, entity):
    _, df = hot
    small_partitions(conf)
    keys = sorted({k for k, *_ in hot[0]})
    attrs = spark.createDataFrame([(k, n, f"{n}-{k}") for k in keys for n in ("A", "B")], f"{entity} string, control_name string, control_value string")
    named = spark.createDataFrame([(k, "n-" + k) for k in keys], "Id string, Name string")
    facts = df.select(F.col("id").alias("order_item_id"), F.col("k").alias(entity)).repartition(8, "order_item_id")
    out = jo.enrich(facts, co.with_map(named, "Id", co.attribute_map(attrs, entity, "m"), entity), entity, "Id", {"name": "Name", "m": "m"})
    rows = out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == N
    assert all((r.name, [tuple(e) for e in r.m]) == (f"n-{r[entity]}", [("A", f"A-{r[entity]}"), ("B", f"B-{r[entity]}")]) for r in rows)


def test_unpaid_orders_are_spread(spark, conf):
    small_partitions(conf)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(str(i), None if i % 3 == 0 else f"p{i}") for i in range(N)]
    orders = spark.createDataFrame(rows, "order_id string, payment_transaction_id string")
    pays = spark.createDataFrame([(f"p{i}", "o", i) for i in range(N)] + [(None, "o", -1), ("", "o", -2)], "payment_transaction_id string, order_id string, amount int")
    out = jo.attach_payment(orders, pays).withColumn("task", F.spark_partition_id()).collect()
    assert len(out) == N
    assert all(r.amount == (None if int(r.order_id) % 3 == 0 else int(r.order_id)) for r in out)
    tasks = Counter(r.task for r in out if r.amount is None)
    assert len(tasks) > 8 and max(tasks.values()) < N / 3 / 4


def test_hot_key_of_a_join_is_split(spark, conf, hot):
    _, df = hot
    small_partitions(conf)
    keys = sorted({k for k, *_ in hot[0]})
    dim = spark.createDataFrame([(k, "n-" + k) for k in keys], "k string, name string")
    facts = df.repartition(8, "id")
    out = jo.enrich(facts, dim, "k", "k", {"name": "name"})
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == N and all(r.name == "n-" + r.k for r in rows)
