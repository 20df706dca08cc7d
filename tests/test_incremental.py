"""Facts and history brought up to date in part equal those made as a whole."""

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratum.__main__ import main
from stratum.operators.enrich import as_of_join, point_in_time_join
from stratum.operators.scd2 import scd2_change, scd2_frame, scd2_merge
from stratum.plans import lakehouse, silver
from stratum.sources import tables
from stratum.sources.bronze import expire, land
from stratum.sources.registry import SourceSpec
from tests.conftest import plan_of, rows
from tests.test_lakehouse import config, lake  # noqa: F401

BRONZE = "transaction_id string, customer_id string, amount string, transaction_ts string"
START = date(2024, 1, 1)


def landed_day(draw, n=40):
    """Repeated and late ids, dates that move, invalid late copies, null ids and null dates."""
    return [
        (
            None if draw.random() < 0.03 else f"t{draw.randrange(60)}",
            None if draw.random() < 0.1 else f"c{draw.randrange(5)}",
            draw.choice(["n/a", "-3", "0", *map(str, range(1, 9))]),
            draw.choice([None, "later", *(f"2023-12-0{d} 10:00:00" for d in range(1, 8))]),
        )
        for _ in range(n)
    ]


FACTS = ["transaction_id", "customer_id", "amount", "transaction_ts", "transaction_date", "ingest_date"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changed_facts_equal_a_full_rebuild(spark, tmp_path, seed):
    draw = random.Random(seed)
    bronze_root, path = str(tmp_path / "bronze"), str(tmp_path / "fct")
    fresh = 0
    for step in range(5):
        # Some days are landed again, with other rows.
        days = {START + timedelta(days=draw.randrange(fresh)) for _ in range(step and draw.randrange(2))}
        days.add(START + timedelta(days=fresh))
        fresh += 1
        for day in sorted(days):
            df = spark.createDataFrame(landed_day(draw), BRONZE)
            if step == 2:
                df = df.withColumn("channel", F.lit("web"))
            land(df, bronze_root, "s", datetime(day.year, day.month, day.day, 6))
        bronze = tables.load_table_files(spark, f"{bronze_root}/s")
        whole = silver.silver_transactions(bronze, f"2024-02-0{step + 1} 00:00:00")
        if step == 0:
            tables.overwrite_table(whole, path, "transaction_date")
            continue
        facts = tables.read_table(spark, path)
        change = silver.changed_facts(bronze, facts, sorted(days), f"2024-02-0{step + 1} 00:00:00")
        if change.dates:
            tables.replace_partitions(change.rows, path, "transaction_date", change.dates)
        names = [*FACTS, "channel"] if step >= 2 and "channel" in whole.columns else FACTS
        stored = spark.read.option("mergeSchema", True).parquet(path)
        stored = stored if "channel" in stored.columns else stored.withColumn("channel", F.lit(None).cast("string"))
        assert rows(stored.select(names)) == rows(whole.select(names)), step


def test_change_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "fct")
    first = [(f"t{i}", "c", "5", f"2023-12-{i % 28 + 1:02d} 10:00:00") for i in range(280)]
    land(spark.createDataFrame(first, BRONZE), str(tmp_path / "b"), "s", datetime(2024, 1, 1))
    bronze = tables.load_table_files(spark, f"{tmp_path}/b/s")
    tables.overwrite_table(silver.silver_transactions(bronze), path, "transaction_date")
    land(
        spark.createDataFrame([("t3", "c", "9", "2023-12-20 11:00:00")], BRONZE),
        str(tmp_path / "b"), "s", datetime(2024, 1, 2),
    )
    bronze = tables.load_table_files(spark, f"{tmp_path}/b/s")
    change = silver.changed_facts(bronze, tables.read_table(spark, path), [date(2024, 1, 2)])
    assert sorted(change.dates) == [date(2023, 12, 4), date(2023, 12, 20)]
    assert change.rows.count() == 20
    plan = plan_of(change.rows)
    assert "PartitionFilters: [transaction_date" in plan and "PartitionFilters: [isnotnull(ingest_date" in plan
    # Every scan of facts or bronze is cut by its partition column.
    assert plan.count("FileScan") == plan.count("PartitionFilters: [") - plan.count("PartitionFilters: []")


@pytest.mark.parametrize("full", [True, False])
def test_stored_merge_equals_the_merge_of_all_history(spark, tmp_path, full):
    draw = random.Random(9 + full)
    path = str(tmp_path / "dim")

    def snapshot():
        people = draw.sample(range(25), 15)
        return spark.createDataFrame([(f"c{i}", draw.choice("xyz")) for i in people], "id string, segment string")

    first = snapshot()
    whole = scd2_frame(first, START)
    tables.overwrite_table(whole, path, "effective_to")
    closed_files = {}
    for step in range(1, 6):
        day, feed = START + timedelta(days=(step + 1) // 2), snapshot()  # two feeds on some days
        merged = scd2_merge(whole, feed, ["id"], ["segment"], day, full)
        whole = spark.createDataFrame(merged.collect(), whole.schema)
        for _ in range(2):  # a second time without effect
            change, parts = scd2_change(tables.read_table(spark, path), feed, ["id"], ["segment"], day, full)
            tables.replace_partitions(change, path, "effective_to", parts)
        assert rows(tables.read_table(spark, path).select(whole.columns)) == rows(whole)
        folders = tables.folder_values(spark, path, "effective_to")
        for value in folders:
            files = tables._data_files(spark, f"{path}/effective_to={value}")
            if value not in map(str, parts):
                assert files == closed_files[value]
            closed_files[value] = files


def test_as_of_join_equals_the_join(spark):
    draw = random.Random(4)
    day = lambda: START + timedelta(days=draw.randrange(40))
    facts = [(i, draw.choice(["hot", "a", "b", "none", None]), draw.choice([None, day()])) for i in range(400)]
    facts += facts[:10]
    versions = []
    for key in ("hot", "a", "b"):
        cuts = sorted({day() for _ in range(12)})
        versions += [(key, s, e, f"{key}{s}") for s, e in zip(cuts, cuts[1:]) if draw.random() < 0.8]
        versions.append((key, cuts[0], cuts[0], "opened and closed on one day"))
    versions.append((None, START, date(9999, 12, 31), "of nobody"))
    facts = spark.createDataFrame(facts, "no int, who string, at date")
    history = spark.createDataFrame(versions, "who string, effective_from date, effective_to date, name string")
    expected = rows(point_in_time_join(facts, history, "who", "at", ["name"]))
    for salts in (1, 4):
        found = as_of_join(facts, history, "who", "at", ["name"], salts=salts)
        assert found.columns == ["no", "who", "at", "name"] and rows(found) == expected
        assert "Join" not in plan_of(found)
    assert any(row[3] for row in expected)


GOLD = ("agg_revenue_by_segment", "dim_customer_ltv", "mart_daily_revenue", "mart_customer_360")


@pytest.mark.parametrize("schemas", [None, "inc_{layer}"])
def test_incremental_lake_equals_the_rebuilt_one(spark, tmp_path, config, schemas):  # noqa: F811
    one = [replace(lake(tmp_path, d), root=str(tmp_path / "inc"), schemas=schemas) for d in (1, 2, 3)]
    other = [replace(lake(tmp_path, d), root=str(tmp_path / "whole")) for d in (1, 2, 3)]
    header = "transaction_id,customer_id,amount,transaction_ts"
    people = "customer_id,segment,region,signup_date,lifetime_value\nc1,A,EU,2023-01-01,100\n"
    days = [
        (f"{header}\nt1,c1,5,2024-01-01 10:00:00\nt2,c2,7,2024-01-02 10:00:00\n", f"{people}c2,B,EU,2023-06-01,0\n"),
        (f"{header},via\nt1,c1,6,2024-01-03 10:00:00,web\nt3,c2,1,2024-01-02 10:00:00,web\n", f"{people}c2,Z,EU,2023-06-01,0\n"),
        (f"{header},via\nt2,c1,-6,2024-01-03 10:00:00,web\nt4,c3,2,2024-01-05 10:00:00,app\n", f"{people}c3,Z,EU,2023-06-01,0\n"),
    ]
    for i, (transactions, customers) in enumerate(days):
        (tmp_path / "transactions.csv").write_text(transactions, encoding="utf-8")
        (tmp_path / "customers.csv").write_text(customers, encoding="utf-8")
        lakehouse.run(spark, config, one[i], incremental=True)
        lakehouse.run(spark, config, other[i])
        for layer, names in (("silver", ("fct_transactions", "dim_customer")), ("gold", GOLD)):
            for name in names:
                got, expected = (x.read(spark, layer, name).drop("_processed_at", "processed_at", "via") for x in (one[i], other[i]))
                assert rows(got.select(expected.columns)) == rows(expected), (i, name)
    report = lakehouse.freshness_report(spark, replace(config, sources=tuple(replace(s, sla_hours=1) for s in config.sources)), one[2])
    assert {r["status"] for r in report.collect()} == {"pass"} and report.count() == 4


@pytest.mark.parametrize("schema", [None, "expiring"])
def test_expire_drops_whole_days(spark, tmp_path, schema):
    for month in (1, 2, 3):
        land(spark.range(month), str(tmp_path), "s", datetime(2024, month, 1), schema=schema)
    specs = [SourceSpec("s", "flat_file"), SourceSpec("never_landed", "flat_file")]
    gone = expire(spark, specs, str(tmp_path), date(2024, 4, 1), 45, schema=schema)
    assert gone["s"] == ["2024-01-01", "2024-02-01"]
    left = spark.table("expiring.s") if schema else tables.read_table(spark, f"{tmp_path}/s")
    assert rows(left.select("id", "ingest_date")) == [(i, date(2024, 3, 1)) for i in range(3)]


def test_command_line_with_catalog(spark, tmp_path, config):  # noqa: F811
    import json

    registry = tmp_path / "sources.json"
    sources = [{"name": s.name, "type": s.type, "path": s.path} for s in config.sources]
    registry.write_text(json.dumps({"sources": sources, "bronze_retention_days": 30}), encoding="utf-8")
    common = ["--root", str(tmp_path / "lake"), "--config", str(registry), "--schemas", "cli_{layer}"]
    assert main(["run", *common]) == 0
    assert main(["run", "--incremental", *common]) == 0
    assert main(["expire", "--as-of", "2000-01-01", *common]) == 0
    assert spark.table("cli_silver.fct_transactions").count() == 4
    assert main(["expire", "--as-of", "9000-01-01", *common]) == 0
    assert spark.table("cli_bronze.customer_transactions").count() == 0


def test_change_moves_each_row_by_its_id_once(spark, tmp_path):
    day = [datetime(2024, 1, d) for d in (1, 2)]
    old = [(f"t{i}", "c", "5", f"2023-12-{i % 28 + 1:02d} 10:00:00") for i in range(100)]
    land(spark.createDataFrame([*old, (None, "c", "4", "2023-12-01 10:00:00")], BRONZE), str(tmp_path / "b"), "s", day[0])
    bronze = tables.load_table_files(spark, f"{tmp_path}/b/s")
    path = str(tmp_path / "fct")
    facts = silver.silver_transactions(bronze, day[0])
    # A repeated id that is not touched stays as it is, a touched one is reduced.
    repeated = facts.filter("transaction_id in ('t3', 't31')").withColumn("note", F.lit("again"))
    tables.overwrite_table(facts.unionByName(repeated, allowMissingColumns=True), path, "transaction_date")
    landed = [("t3", "c", "9", "2023-12-04 11:00:00"), (None, "d", "7", "2023-12-04 12:00:00"), ("u", "c", "1", None)]
    land(spark.createDataFrame(landed, BRONZE), str(tmp_path / "b"), "s", day[1])
    bronze = tables.load_table_files(spark, f"{tmp_path}/b/s")
    change = silver.changed_facts(bronze, tables.read_table(spark, path), [day[1].date()], day[1])
    assert sorted(change.dates, key=str) == [date(2023, 12, 1), date(2023, 12, 4), None]
    found = change.rows.filter("transaction_id in ('t3', 't31', 'u') or transaction_id is null")
    assert rows(found.select("transaction_id", "customer_id", "amount_usd", "_processed_at", "note")) == sorted(
        [
            ("t3", "c", 9.0, day[1], None), ("t31", "c", 5.0, day[0], None), ("t31", "c", 5.0, day[0], "again"),
            ("u", "c", 1.0, day[1], None), (None, "d", 7.0, day[1], None),
        ],
        key=repr,
    )
    plan = plan_of(change.rows)
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2
