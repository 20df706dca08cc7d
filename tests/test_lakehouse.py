import json
from dataclasses import replace
from datetime import date, datetime

import pytest

from stratum.__main__ import main
from stratum.operators.quality import QualityGateError
from stratum.plans import lakehouse
from stratum.sources.registry import load_sources
from stratum.sources.tables import read_table, table_exists
from tests.conftest import rows

TRANSACTIONS = """transaction_id,customer_id,amount,transaction_ts
t1,c1,100.50,2024-01-01 10:00:00
t2,c1,9950.00,2024-02-01 11:00:00
t3,c2,20.00,2024-02-01 12:00:00
t4,,5.00,2024-02-01 12:00:00
t5,c2,n/a,2024-02-01 12:00:00
t6,c9,30.00,2024-02-01 12:00:00
"""
CUSTOMERS = """customer_id,segment,region,signup_date,lifetime_value
c1,A,EU,2023-01-01,100
c2,B,EU,2023-06-01,0
"""


@pytest.fixture
def config(tmp_path):
    (tmp_path / "transactions.csv").write_text(TRANSACTIONS, encoding="utf-8")
    (tmp_path / "customers.csv").write_text(CUSTOMERS, encoding="utf-8")
    pages = {"results": [{"sku": "p1", "price": {"list": 2.5}}]}
    (tmp_path / "products.json").write_text(json.dumps(pages), encoding="utf-8")
    return load_sources(
        {
            "sources": [
                {"name": "customer_transactions", "type": "flat_file", "path": f"{tmp_path}/transactions.csv"},
                {"name": "customer_master", "type": "flat_file", "path": f"{tmp_path}/customers.csv"},
                {"name": "product_catalog", "type": "rest_api", "path": f"{tmp_path}/products.json"},
            ]
        }
    )


def lake(tmp_path, day):
    return lakehouse.Lake(str(tmp_path / "lake"), date(2024, 3, day), datetime(2024, 3, day, 6))


def table(spark, a_lake, layer, name):
    return read_table(spark, a_lake.path(layer, name))


def test_end_to_end_twice_and_with_a_change(spark, tmp_path, config):
    first = lake(tmp_path, 1)
    outcome = lakehouse.run(spark, config, first)
    assert [(r.source_name, r.row_count) for r in outcome.ingested] == [
        ("customer_transactions", 6), ("customer_master", 2), ("product_catalog", 1),
    ]
    assert outcome.rows["fct_transactions"] == 4 and outcome.rows["dim_customer"] == 2
    assert all(check.success for check in outcome.checks) and len(outcome.checks) == 4
    assert table(spark, first, "bronze", "product_catalog").select("`price.list`").first()[0] == 2.5
    c360 = {r.customer_id: r for r in table(spark, first, "gold", "mart_customer_360").collect()}
    assert (c360["c1"].value_tier, c360["c1"].engagement_status) == ("platinum", "active")
    assert c360["c9"].customer_segment is None
    assert lakehouse.register_views(spark, first) == ["fct_transactions", "dim_customer", *GOLD]
    top = spark.sql("SELECT customer_id FROM mart_customer_360 WHERE value_tier = 'platinum'")
    assert rows(top) == [("c1",)]
    before = {name: rows(table(spark, first, "gold", name)) for name in GOLD}

    lakehouse.run(spark, config, first)
    assert {name: rows(table(spark, first, "gold", name)) for name in GOLD} == before

    (tmp_path / "customers.csv").write_text(CUSTOMERS.replace("c2,B", "c2,Z"), encoding="utf-8")
    lines = TRANSACTIONS.replace("t3,c2,20.00", "t3,c2,21.00").splitlines()
    widened = [lines[0] + ",channel"] + [line + ",web" for line in lines[1:]]
    (tmp_path / "transactions.csv").write_text("\n".join(widened) + "\n", encoding="utf-8")
    second = lake(tmp_path, 2)
    lakehouse.run(spark, config, second)
    history = table(spark, second, "silver", "dim_customer").filter("customer_id = 'c2'")
    assert rows(history.select("segment", "effective_from", "effective_to", "is_current")) == [
        ("B", date(2024, 3, 1), date(2024, 3, 2), False),
        ("Z", date(2024, 3, 2), date(9999, 12, 31), True),
    ]
    facts = table(spark, second, "silver", "fct_transactions").filter("transaction_id = 't3'")
    assert [(r.amount_usd, r.channel) for r in facts.collect()] == [(21.0, "web")]
    assert table(spark, second, "gold", "mart_daily_revenue").filter(
        "customer_segment = 'Z'"
    ).count() == 1


GOLD = ("agg_revenue_by_segment", "dim_customer_ltv", "mart_daily_revenue", "mart_customer_360")


@pytest.mark.parametrize("full_snapshot", [True, False])
def test_customer_missing_from_the_next_feed(spark, tmp_path, config, full_snapshot):
    lakehouse.run(spark, config, lake(tmp_path, 1), full_snapshot)
    shorter = "".join(CUSTOMERS.splitlines(keepends=True)[:2])
    (tmp_path / "customers.csv").write_text(shorter, encoding="utf-8")
    second = lake(tmp_path, 2)
    lakehouse.run(spark, config, second, full_snapshot)
    history = table(spark, second, "silver", "dim_customer").select("customer_id", "is_current")
    assert rows(history) == [("c1", True), ("c2", not full_snapshot)]


def test_freshness_report(spark, tmp_path, config):
    first = lake(tmp_path, 1)
    lakehouse.run(spark, config, first)
    with_sla = replace(
        config, sources=tuple(replace(s, sla_hours=h) for s, h in zip(config.sources, (6, 24, None)))
    )
    later = replace(first, batch_ts=datetime(2024, 3, 1, 19))
    report = lakehouse.freshness_report(spark, with_sla, later)
    assert {r["name"]: (r["age_seconds"], r["status"]) for r in report.collect()} == {
        "fct_transactions": (13 * 3600, "warn"),
        "customer_transactions": (13 * 3600, "error"),
        "customer_master": (13 * 3600, "pass"),
    }
    assert lakehouse.freshness_report(spark, config, first).count() == 1


def test_failed_gate_blocks_gold(spark, tmp_path, config):
    nothing_valid = TRANSACTIONS.splitlines()[0] + "\nt1,c1,-1,2024-01-01\n"
    (tmp_path / "transactions.csv").write_text(nothing_valid, encoding="utf-8")
    blocked = lake(tmp_path, 1)
    with pytest.raises(QualityGateError):
        lakehouse.run(spark, config, blocked)
    assert not table_exists(spark, blocked.path("gold", "mart_daily_revenue"))


def test_missing_table_blocks_unless_allowed(spark, tmp_path):
    empty = lake(tmp_path, 1)
    with pytest.raises(QualityGateError, match="table is missing"):
        lakehouse.check_layer(spark, empty, "gold", lakehouse.gold_rules())
    assert lakehouse.check_layer(spark, empty, "gold", lakehouse.gold_rules(), True) == []
    assert lakehouse.register_views(spark, empty) == []


def test_command_line(spark, tmp_path, config):
    registry = tmp_path / "sources.json"
    registry.write_text(
        json.dumps({"sources": [{"name": s.name, "type": s.type, "path": s.path} for s in config.sources]}),
        encoding="utf-8",
    )
    root = str(tmp_path / "lake")
    common = ["--root", root, "--as-of", "2024-03-01"]
    assert main(["run", "--config", str(registry), *common]) == 0
    assert main(["check-gold", *common]) == 0
    assert main(["freshness", "--config", str(registry), *common]) == 0
    assert main(["check-gold", "--root", str(tmp_path / "empty")]) == 1
    assert main(["check-gold", "--root", str(tmp_path / "empty"), "--allow-missing"]) == 0
    tier = read_table(spark, f"{root}/gold/dim_customer_ltv").filter("customer_id = 'c1'").first()
    assert tier.tenure_days == 425
    with pytest.raises(SystemExit):
        main(["run", *common])


def test_lake_now():
    assert lakehouse.Lake.now("/x").path("silver", "t") == "/x/silver/t"
