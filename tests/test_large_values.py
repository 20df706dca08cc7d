"""Amounts of any finite size, odd payloads and registries: nothing is lost on the way."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum.functions import cents_to_dollars
from stratum.plans import gold, marts, silver
from stratum.sources.payloads import unwrap_payloads
from stratum.sources.registry import SourceSpec, load_sources
from stratum.streaming.landing import land_new_files
from tests.conftest import rows

BRONZE = "transaction_id string, customer_id string, amount string, transaction_ts string, _ingested_at timestamp"


def facts(spark, *amounts):
    data = [(f"n{i}", "ann", a, "2024-03-05 10:00:00", None) for i, a in enumerate(amounts)]
    return silver.silver_transactions(spark.createDataFrame(data, BRONZE), "2024-03-06 00:00:00")


def customers(spark):
    return spark.sql(
        "select 'ann' as customer_id, 'S' as segment, 'R' as region, date '2020-01-01' as signup_date,"
        " 3e13D as lifetime_value, date '2020-01-01' as effective_from, date '9999-12-31' as effective_to,"
        " true as is_current"
    )


def test_marts_and_gold_agree_on_large_amounts(spark):
    fct = facts(spark, "20000000000", "5", "70000000000000.25")
    expected = 70020000000005.25
    by_segment = gold.revenue_by_segment(fct, customers(spark)).first()
    assert by_segment["total_revenue"] == expected
    staged, dim = marts.stg_transactions(fct), marts.stg_customers(customers(spark))
    assert float(dim.first()["crm_lifetime_value"]) == 3e13
    for unique in (True, False):
        daily = marts.daily_revenue(staged, dim, unique_transactions=unique).first()
        assert float(daily["total_revenue"]) == expected
    assert staged.filter("transaction_amount is null").count() == 0


def test_amounts_beyond_cents_stop_the_marts(spark):
    staged = marts.stg_transactions(facts(spark, "1e20"))
    with pytest.raises(PySparkException):
        marts.daily_revenue(staged, marts.stg_customers(customers(spark)), unique_transactions=True).collect()


def test_staged_nan_is_null(spark):
    assert marts.stg_transactions(facts(spark, "NaN", "7")).filter("transaction_amount is null").count() == 1


def test_cents_of_any_size(spark):
    df = spark.sql("select 1000000000000000 as c union all select 123456789012345678")
    out = {str(r[0]) for r in df.select(F.round(cents_to_dollars(F.col("c")), 2).cast("decimal(30,2)")).collect()}
    assert out == {"10000000000000.00", "1234567890123456.78"}


def payload(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "p string")


def test_fields_named_like_types_stay(spark):
    df = unwrap_payloads(payload(spark, '[{"VARIANT": 1, "b": 2, "VOID": null, "x y": {"OBJECT": 1.5}}]'), "p")
    assert sorted(df.columns) == sorted(["VARIANT", "b", "VOID", "x y"])
    assert df.select("VARIANT", "b", "`x y`.OBJECT").first() == (1, 2, 1.5)


def test_results_as_one_object(spark):
    df = unwrap_payloads(payload(spark, '{"results": {"a": 1}}', '{"results": [{"a": 2}]}', '{"a": 3}', '{"results": []}'), "p")
    assert rows(df.select("a")) == [(1,), (2,), (3,)]


def test_unknown_keys_of_one_source_stop_nothing():
    config = load_sources({"sources": [{"name": "a", "type": "flat_file", "colour": 1}, {"name": "b", "type": "flat_file"}]})
    assert [s.name for s in config.sources] == ["a", "b"]
    assert config.sources[0].extra == {"colour": 1}


def test_rows_of_many_batches_are_counted(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(104):
        (landing / f"{i}.csv").write_text(f"a\n{i}\n", encoding="utf-8")
    spec = SourceSpec("s", "flat_file", str(landing), schema="a string", options={"maxFilesPerTrigger": "1"})
    assert land_new_files(spark, spec, str(tmp_path / "bronze"), str(tmp_path / "state")) == 104
