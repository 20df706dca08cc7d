from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratum.plans import silver
from tests.conftest import rows

RAW = "transaction_id string, customer_id string, amount string, transaction_ts string, _ingested_at timestamp"
D1, D2 = datetime(2020, 1, 1), datetime(2020, 1, 2)
PROCESSED = "2020-01-03 00:00:00"


def facts(spark, data):
    return silver.silver_transactions(spark.createDataFrame(data, RAW), PROCESSED)


def test_invalid_rows_are_dropped_and_nan_is_kept(spark):
    amounts = ["n/a", "0", "-1", None, "NaN", "10.005", "5"]
    data = [(str(i), "c", a, "2020-01-01 13:45:00", D1) for i, a in enumerate(amounts)]
    data.append(("9", None, "5", "2020-01-01", D1))
    got = {r.transaction_id: r.amount_usd for r in facts(spark, data).collect()}
    assert got.keys() == {"4", "5", "6"}
    assert got["5"] == 10.01 and got["6"] == 5.0 and got["4"] != got["4"]


def test_enrichment(spark):
    row = facts(spark, [("1", "c", "5", "2020-01-01 13:45:00", D1)]).first()
    assert row.transaction_date == date(2020, 1, 1)
    assert row.transaction_hour == 13
    assert row._processed_at == datetime(2020, 1, 3)


def test_unparseable_time_becomes_null(spark):
    row = facts(spark, [("1", "c", "5", "yesterday", D1)]).first()
    assert (row.transaction_ts, row.transaction_date, row.transaction_hour) == (None, None, None)


def test_invalid_late_copy_does_not_hide_a_valid_one(spark):
    data = [("1", "c", "5", "2020-01-01", D1), ("1", "c", "-5", "2020-01-01", D2)]
    assert [r.amount for r in facts(spark, data).collect()] == [5.0]


def test_null_ids_collapse_to_one_row(spark):
    data = [(None, "c", "5", "2020-01-01", D1), (None, "d", "6", "2020-01-01", D2)]
    assert [r.customer_id for r in facts(spark, data).collect()] == ["d"]


def test_unlisted_columns_pass_through(spark):
    df = spark.createDataFrame([("1", "c", "5", "2020-01-01", D1)], RAW).withColumn("note", F.lit("x"))
    assert silver.silver_transactions(df).first().note == "x"


def test_processed_at_defaults_to_now(spark):
    row = silver.silver_transactions(
        spark.createDataFrame([("1", "c", "5", "2020-01-01", D1)], RAW)
    ).first()
    assert row._processed_at is not None


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [
            ("1", "A", "R", "2019-05-01", "10.5", D1),
            ("1", "B", "R", "2019-05-01", "11", D2),
            ("2", "A", None, "not a date", "x", D1),
            (None, "A", "R", "2019-05-01", "1", D1),
        ],
        "customer_id string, segment string, region string, signup_date string, lifetime_value string,"
        " _ingested_at timestamp",
    )


def test_customers_latest_wins_and_are_framed(customers):
    got = silver.silver_customers(customers, "2020-02-01", PROCESSED).drop("_ingested_at", "_processed_at")
    end = date(9999, 12, 31)
    assert rows(got) == [
        ("1", "B", "R", date(2019, 5, 1), 11.0, date(2020, 2, 1), end, True),
        ("2", "A", None, None, None, date(2020, 2, 1), end, True),
    ]
