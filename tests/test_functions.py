import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratum.functions import (
    active_span_days,
    cents,
    cents_as_double,
    cents_to_dollars,
    days_before,
    engagement_status,
    mean_cents,
    safe_divide,
    sum_cents,
    surrogate_key,
    tenure_days,
    value_tier,
)

AS_OF = "2001-08-01"


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_safe_divide_is_null_for_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    assert one(df, safe_divide(F.col("n"), F.col("d"))) == [0.5, None, None, None]


def test_safe_divide_on_decimals(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("0.00"))], "n decimal(12,2), d decimal(12,2)")
    assert one(df, safe_divide(F.col("n"), F.col("d"))) == [None]


def test_surrogate_key_spells_out_nulls(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 2)), (None, None)], "k string, d date")
    expected = [hashlib.md5(t.encode()).hexdigest() for t in ("a-2020-01-02", "_null_-_null_")]
    assert one(df, surrogate_key("k", F.col("d"))) == expected


def test_cents_to_dollars(spark):
    df = spark.createDataFrame([("12345",), ("x",), (None,)], "c string")
    assert one(df, cents_to_dollars(F.col("c"))) == [Decimal("123.45"), None, None]
    assert one(df.limit(1), cents_to_dollars(F.col("c"), 1)) == [Decimal("123.5")]


def test_cents_to_dollars_of_odd_amounts(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("",), ("100000000000000000",)], "c string")
    assert one(df, cents_to_dollars(F.col("c"))) == [None, None, None, Decimal("1000000000000000.00")]
    for wide in ("1e30", "-99999999999999999999999999999"):
        with pytest.raises(Exception, match="cents beyond"):
            one(spark.createDataFrame([(wide,)], "c string"), cents_to_dollars(F.col("c")))
    doubles = spark.createDataFrame([(float("nan"),), (1e17,)], "c double")
    assert one(doubles, cents_to_dollars(F.col("c"))) == [None, Decimal("1000000000000000.00")]


def test_value_tier_thresholds_are_inclusive(spark):
    spends = [10000.0, 9999.99, 5000.0, 4999.99, 1000.0, 999.99, 0.0, None]
    df = spark.createDataFrame([(s,) for s in spends], "s double")
    assert one(df, value_tier(F.col("s"))) == [
        "platinum", "gold", "gold", "silver", "silver", "bronze", "bronze", "bronze",
    ]


def test_engagement_limits_are_strict(spark):
    df = spark.createDataFrame([(n,) for n in (91, 90, 31, 30, 0, None)], "n int")
    last = F.date_sub(F.lit(AS_OF).cast("date"), F.col("n"))
    assert one(df, engagement_status(last, AS_OF)) == [
        "churned", "at_risk", "at_risk", "active", "active", "active",
    ]


def test_dates(spark):
    df = spark.range(1).select(F.lit("2001-07-01").cast("date").alias("d"))
    assert one(df, tenure_days(F.col("d"), AS_OF)) == [31]
    assert one(df, active_span_days(F.col("d"), F.lit(AS_OF).cast("date"))) == [31]
    assert one(df, days_before(AS_OF, 31)) == [date(2001, 7, 1)]
    assert one(df, tenure_days(F.current_date())) == [0]


def test_cents_and_mean_round_half_up(spark):
    df = spark.createDataFrame([(1.01,), (0.1,), (0.2,), (None,)], "a double")
    total = df.agg(sum_cents(cents(F.col("a"))).alias("c"), F.count("a").alias("n"))
    row = total.select("c", cents_as_double(F.col("c")), mean_cents(F.col("c"), F.col("n"))).first()
    assert tuple(row) == (131, 1.31, Decimal(44))


@pytest.mark.parametrize("total, n, expected", [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (1, 0, None)])
def test_mean_cents(spark, total, n, expected):
    got = spark.range(1).select(mean_cents(F.lit(total), F.lit(n))).first()[0]
    assert got == expected


def test_sum_cents_never_wraps(spark):
    huge = spark.range(3).select(F.lit(9_000_000_000_000_000_000).alias("c"))
    with pytest.raises(Exception, match="exceeds bigint"):
        huge.agg(sum_cents(F.col("c"))).collect()
    assert huge.filter("id < 0" if "id" in huge.columns else "c < 0").agg(
        sum_cents(F.col("c"))
    ).first()[0] is None
