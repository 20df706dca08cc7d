"""Silver -> gold aggregates.

Facts are summed per customer before they meet the dimension. The map-side half of that
aggregation turns a hot customer into a handful of rows per task, so neither the shuffle nor the
join sees the skew, and the join handles aggregates instead of facts.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import resolve_timestamp, tenure_days
from stratum.functions.money import add_up_cents, cents, cents_as_double, mean_cents, sum_cents
from stratum.functions.tiers import value_tier
from stratum.operators.enrich import attribute_sets


def _partial_sums(amount: Column) -> dict[str, Column]:
    """Exact cents, plus a plain double sum of what has no cents (NaN, infinity, huge)."""
    whole = cents(amount)
    return {
        "_n_amounts": F.count(amount),
        "_cents": sum_cents(whole),
        "_inexact": F.sum(F.when(whole.isNull(), amount)),
    }


def _total(total_cents: Column, inexact: Column) -> Column:
    exact = cents_as_double(total_cents)
    return F.when(inexact.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + inexact)


def _mean(total_cents: Column, inexact: Column, n: Column) -> Column:
    exact = cents_as_double(mean_cents(total_cents, n))
    return F.when(inexact.isNull(), exact).otherwise(
        F.round(F.try_divide(_total(total_cents, inexact), n), 2)
    )


def revenue_by_segment(
    transactions: DataFrame,
    customers: DataFrame,
    processed_at: datetime | str | None = None,
    current_only: bool = True,
) -> DataFrame:
    """Transactions, active customers and revenue per day, segment and region.

    ``current_only=False`` joins every version of a customer, as a dimension without history would.
    """
    dim = customers.filter("is_current") if current_only else customers
    per_customer_day = transactions.groupBy("transaction_date", "customer_id").agg(
        F.count("transaction_id").alias("_n"),
        *[c.alias(name) for name, c in _partial_sums(F.col("amount_usd")).items()],
    )
    members = attribute_sets(dim, "customer_id", ["segment", "region"], "_versions")
    weight = F.coalesce(F.col("_versions"), F.lit(1))
    grouped = (
        per_customer_day.join(members, "customer_id", "left")
        .groupBy("transaction_date", "segment", "region")
        .agg(
            F.sum(F.col("_n") * weight).alias("transaction_count"),
            F.count("customer_id").alias("active_customers"),
            F.sum(F.col("_n_amounts") * weight).alias("_n_amounts"),
            add_up_cents(F.col("_cents"), weight).alias("_cents"),
            F.sum(F.col("_inexact") * weight).alias("_inexact"),
        )
    )
    total_cents, inexact = F.col("_cents"), F.col("_inexact")
    return grouped.select(
        "transaction_date",
        "segment",
        "region",
        "transaction_count",
        "active_customers",
        _total(total_cents, inexact).alias("total_revenue"),
        _mean(total_cents, inexact, F.col("_n_amounts")).alias("avg_transaction_value"),
        resolve_timestamp(processed_at).alias("_processed_at"),
    )


def customer_summary(transactions: DataFrame) -> DataFrame:
    """Lifetime counts, spend and first / last day per customer."""
    return (
        transactions.groupBy("customer_id")
        .agg(
            F.count("transaction_id").alias("lifetime_transactions"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
            *[c.alias(name) for name, c in _partial_sums(F.col("amount_usd")).items()],
        )
        .select(
            "customer_id",
            "lifetime_transactions",
            _total(F.col("_cents"), F.col("_inexact")).alias("lifetime_spend"),
            "first_transaction_date",
            "last_transaction_date",
        )
    )


def customer_ltv(
    transactions: DataFrame,
    customers: DataFrame,
    as_of: date | str | None = None,
    processed_at: datetime | str | None = None,
) -> DataFrame:
    """Every current customer with lifetime figures; one without transactions has nulls, tier bronze."""
    enriched = customers.filter("is_current").join(
        customer_summary(transactions), "customer_id", "left"
    )
    return enriched.withColumns(
        {
            "tenure_days": tenure_days(F.col("signup_date"), as_of),
            "customer_tier": value_tier(F.col("lifetime_spend")),
            "_processed_at": resolve_timestamp(processed_at),
        }
    )
