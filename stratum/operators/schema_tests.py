"""Column tests that return the failing rows, and freshness of loaded tables.

Unlike the contracts in ``quality``, nulls pass every test but ``not_null``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import resolve_timestamp
from stratum.functions.tiers import ENGAGEMENT_STATUSES, VALUE_TIERS
from stratum.operators.quality import Expectation

SECONDS_PER_HOUR = 3600


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    value = F.col(column)
    return (
        df.filter(value.isNotNull())
        .groupBy(value.alias(column))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_rows(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def out_of_range_rows(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Rows outside the inclusive range."""
    bounds = []
    if min_value is not None:
        bounds.append(F.col(column) >= min_value)
    if max_value is not None:
        bounds.append(F.col(column) <= max_value)
    return df.filter(~reduce(Column.__and__, bounds))


def not_null_test(column: str) -> Expectation:
    return Expectation(f"not_null({column})", F.count_if(F.col(column).isNull()) == 0)


def unique_test(column: str) -> Expectation:
    return Expectation(f"unique({column})", no_repeats_in=column, ignore_nulls=True)


def accepted_values_test(column: str, values: Sequence) -> Expectation:
    return Expectation(f"accepted_values({column})", F.count_if(~F.col(column).isin(*values)) == 0)


def min_value_test(column: str, min_value) -> Expectation:
    return Expectation(f"min_value({column})", F.count_if(~(F.col(column) >= min_value)) == 0)


def source_and_mart_tests() -> dict[str, list[Expectation]]:
    """The tests declared for each stored table."""
    return {
        "fct_transactions": [
            unique_test("transaction_id"),
            not_null_test("transaction_id"),
            not_null_test("customer_id"),
            not_null_test("amount_usd"),
        ],
        "dim_customer": [not_null_test("customer_id"), not_null_test("is_current")],
        "mart_daily_revenue": [
            not_null_test("transaction_date"),
            not_null_test("total_revenue"),
            not_null_test("active_customers"),
            min_value_test("active_customers", 0),
        ],
        "mart_customer_360": [
            unique_test("customer_id"),
            not_null_test("customer_id"),
            accepted_values_test("value_tier", VALUE_TIERS),
            accepted_values_test("engagement_status", ENGAGEMENT_STATUSES),
        ],
    }


def freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: datetime | str | None = None,
    warn_after_hours: float | None = 12,
    error_after_hours: float | None = 24,
) -> DataFrame:
    """One row: newest load, its age in seconds, and pass / warn / error. Nothing loaded is an error."""
    newest = df.agg(F.max(F.col(loaded_at)).cast("timestamp").alias("max_loaded_at"))
    return _rated(newest, as_of, F.lit(warn_after_hours), F.lit(error_after_hours))


def sla_report(
    bronze: Mapping[str, DataFrame],
    sla_hours: Mapping[str, float],
    as_of: datetime | str | None = None,
    loaded_at: str = "_ingested_at",
) -> DataFrame:
    """Freshness of each bronze table against the SLA of its source; a missed SLA is an error."""
    newest = [
        df.agg(F.max(F.col(loaded_at)).cast("timestamp").alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"),
            F.lit(float(sla_hours[name])).alias("sla_hours"),
            "max_loaded_at",
        )
        for name, df in bronze.items()
    ]
    return _rated(reduce(DataFrame.unionByName, newest), as_of, F.lit(None), F.col("sla_hours"))


def _rated(newest: DataFrame, as_of, warn_after: Column, error_after: Column) -> DataFrame:
    age = F.unix_timestamp(resolve_timestamp(as_of)) - F.unix_timestamp("max_loaded_at")
    late = F.col("age_seconds")
    return newest.withColumn("age_seconds", age).withColumn(
        "status",
        F.when(late.isNull() | (late > error_after * SECONDS_PER_HOUR), "error")
        .when(late > warn_after * SECONDS_PER_HOUR, "warn")
        .otherwise("pass"),
    )
