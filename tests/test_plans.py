"""What the physical plans promise at scale: pushdown, no nested loops, no Python, skew handled."""

import contextlib

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality as dq
from stratum.operators.dedupe import latest_per_key
from stratum.operators.enrich import left_lookup, point_in_time_join
from stratum.plans import gold, lakehouse, marts, silver
from stratum.workloads import fixtures
from stratum.workloads.queries import all_queries
from tests.conftest import plan_of, rows

N = 90_000


@contextlib.contextmanager
def settings(spark, **values):
    values = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def no_broadcast(spark, **more):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        **more,
    )


def exchanged_rows(df) -> list[int]:
    """Rows written by each shuffle of an executed plan, outermost shuffle first."""
    df.collect()
    counts = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return counts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all facts belongs to one customer on one day."""
    hot = F.col("id") % 3 == 0
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.when(hot, 0).otherwise(F.col("id") % 50).cast("int"))
    return spark.range(0, N, 1, 6).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("customer_id"),
        F.lit(1.25).alias("amount_usd"),
        day.cast("timestamp").alias("transaction_ts"),
        day.alias("transaction_date"),
        F.lit(0).alias("transaction_hour"),
        F.lit(None).cast("timestamp").alias("_processed_at"),
    )


@pytest.fixture(scope="module")
def customers(spark):
    snapshot = spark.range(1001).select(
        F.when(F.col("id") == 1000, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        (F.col("id") % 5).cast("string").alias("segment"),
        F.lit("R").alias("region"),
        F.lit("2019-01-01").cast("date").alias("signup_date"),
        F.lit(10.0).alias("lifetime_value"),
        F.lit(None).cast("timestamp").alias("_ingested_at"),
    )
    return silver.silver_customers(snapshot, "2019-01-01", tie_breakers=[])


def staged(skewed, customers):
    return marts.stg_transactions(skewed, "2000-01-01"), marts.stg_customers(customers)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    plan = plan_of(all_queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan


def test_scan_reads_only_needed_columns_and_pushes_filters(spark, sf_dir):
    plan = plan_of(all_queries()["revenue_by_segment"](spark, sf_dir))
    columns = "o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"
    assert f"ReadSchema: struct<{columns}>" in plan
    assert "IsNotNull(o_totalprice)" in plan and "GreaterThan(o_totalprice,0.0)" in plan


def test_date_floor_prunes_partitions(spark, skewed, tmp_path):
    path = str(tmp_path / "fct")
    skewed.limit(2000).write.partitionBy("transaction_date").parquet(path)
    plan = plan_of(marts.stg_transactions(spark.read.parquet(path), "2020-02-01"))
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_dedupe_sends_one_row_per_hot_key_and_task(spark):
    copies = spark.range(0, N, 1, 6).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("at")
    )
    latest = latest_per_key(copies, ["k"], ["at"])
    assert plan_of(latest).count("WindowGroupLimit") == 2
    assert exchanged_rows(latest) == [N * 2 // 3 + 6]


def test_hot_customer_is_summed_before_every_shuffle(spark, skewed, customers):
    inputs = staged(skewed, customers)
    with no_broadcast(spark):
        behaviour = marts.customer_360(*inputs, as_of="2020-06-01", unique_transactions=True)
        ltv = gold.customer_ltv(skewed, customers, "2020-06-01")
        for frame in (behaviour, ltv):
            assert max(exchanged_rows(frame)) <= 6 * 1001
        daily = marts.daily_revenue(*inputs, unique_transactions=True)
        segments = gold.revenue_by_segment(skewed, customers)
        pairs = skewed.select("transaction_date", "customer_id").distinct().count()
        for frame in (daily, segments):
            assert "Expand" not in plan_of(frame)
            assert max(exchanged_rows(frame)) <= 6 * pairs


def test_customer_360_joins_and_regroups_without_another_shuffle(spark, skewed, customers):
    with no_broadcast(spark):
        frame = marts.customer_360(*staged(skewed, customers), unique_transactions=True)
        assert len(exchanged_rows(frame)) == 2


def test_hot_key_of_a_row_level_join_is_split(spark, skewed, customers):
    tiny = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
        "spark__sql__shuffle__partitions": "16",
    }
    with no_broadcast(spark, **tiny):
        transactions, current = staged(skewed.withColumn("customer_id", F.col("customer_id")), customers)
        enriched = marts.transactions_enriched(transactions, current)
        looked_up = point_in_time_join(
            skewed, customers, "customer_id", "transaction_date", ["segment"]
        )
        distinct = marts.daily_revenue(transactions, current)
        for frame, expected in ((enriched, N), (looked_up, N), (distinct, None)):
            got = len(frame.collect())
            assert expected is None or got == expected
            assert "skew=true" in plan_of(frame)


@pytest.mark.parametrize("salts", [1, 8])
def test_salts_do_not_change_the_result(spark, skewed, customers, salts):
    with no_broadcast(spark):
        facts = skewed.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
        plain = facts.join(customers.select("customer_id", "segment"), "customer_id", "left")
        expected = plain.groupBy("customer_id", "segment").count()
        got = left_lookup(facts, customers, "customer_id", ["segment"], salts)
        assert got.columns == plain.columns
        assert rows(got.groupBy("customer_id", "segment").count()) == rows(expected)
        looked_up = point_in_time_join(
            facts, customers, "customer_id", "transaction_date", ["segment"], salts=salts
        )
        assert rows(looked_up.groupBy("customer_id", "segment").count()) == rows(expected)


def test_copies_of_a_small_dimension_are_not_broadcast(spark, sf_dir):
    orders = fixtures.clean_transactions(spark, sf_dir)
    master = fixtures.table(spark, sf_dir, "customer").withColumnRenamed("c_name", "customer_id")
    once = left_lookup(orders, master, "customer_id", ["c_acctbal"])
    copied = left_lookup(orders, master, "customer_id", ["c_acctbal"], salts=16)
    assert "BroadcastHashJoin" in plan_of(once)
    assert "SortMergeJoin" in plan_of(copied) and "Broadcast" not in plan_of(copied)


def test_point_in_time_is_an_equi_join(spark, skewed, customers):
    with no_broadcast(spark):
        looked_up = point_in_time_join(
            skewed, customers, "customer_id", "transaction_date", ["segment"]
        )
        assert "SortMergeJoin [customer_id" in plan_of(looked_up)


def test_contract_has_no_expand_and_scans_ids_apart(spark, skewed):
    split = dq.validation_frame("t", skewed, dq.transactions_contract())
    fused = dq.validation_frame("t", skewed, dq.transactions_contract(), single_pass=True)
    assert "Expand" not in plan_of(split) and "Expand" not in plan_of(fused)
    assert plan_of(split).count("Range (") == 2 and plan_of(fused).count("Range (") == 1
    assert [r.passed for r in split.orderBy("position").collect()] == [
        r.passed for r in fused.orderBy("position").collect()
    ]


def test_uniqueness_rules_of_one_column_share_their_scan(spark, skewed):
    rules = lakehouse.silver_rules()["fct_transactions"]
    for single_pass, scans in ((False, 2), (True, 1)):
        frame = dq.validation_frame("t", skewed, rules, single_pass)
        assert plan_of(frame).count("Range (") == scans
        assert "Expand" not in plan_of(frame)
        assert [r.passed for r in frame.orderBy("position").collect()] == [True] * len(rules)


def test_small_dimension_is_broadcast_by_its_size_only(spark, sf_dir):
    orders = fixtures.clean_transactions(spark, sf_dir).withColumn("amount_usd", F.col("amount"))
    nations = fixtures.table(spark, sf_dir, "nation")
    small = orders.join(nations, orders.customer_id == nations.n_name, "left")
    assert "BroadcastHashJoin" in plan_of(small)
    with no_broadcast(spark):
        again = orders.join(nations, orders.customer_id == nations.n_name, "left")
        assert "SortMergeJoin" in plan_of(again)
