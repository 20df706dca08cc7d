"""Staging projections, the enriched intermediate, and the two marts.

Both marts can be told that ``transaction_id`` is unique (``unique_transactions=True``). Silver
guarantees it by construction and its contract proves it, and it replaces the distinct count, which
would shuffle one row per transaction, by sums per customer. Without that promise they count
distinct ids and are right on any input.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import active_span_days
from stratum.functions.macros import safe_divide
from stratum.functions.money import add_up_cents, cents, cents_as_money, mean_cents, sum_cents
from stratum.functions.tiers import engagement_status, value_tier
from stratum.operators.enrich import attribute_sets, left_lookup

REPORTING_START = "2023-01-01"
MONEY = "decimal(28,2)"
CUSTOMER_ATTRIBUTES = ("customer_segment", "region", "signup_date", "crm_lifetime_value")


def _money(amount: Column) -> Column:
    """Every finite amount, to the cent; one too wide stops the job. NaN and infinity are null."""
    finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    return F.when(finite, amount.cast(MONEY))


def stg_transactions(fct_transactions: DataFrame, reporting_start: date | str = REPORTING_START) -> DataFrame:
    """Typed projection from the reporting start on; the date literal prunes partitions."""
    return fct_transactions.filter(
        F.col("transaction_date") >= F.lit(str(reporting_start)).cast("date")
    ).select(
        "transaction_id",
        "customer_id",
        _money(F.col("amount_usd")).alias("transaction_amount"),
        F.col("transaction_ts").alias("transaction_at"),
        "transaction_date",
        "transaction_hour",
        F.col("_processed_at").alias("processed_at"),
    )


def stg_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.filter("is_current").select(
        "customer_id",
        F.col("segment").alias("customer_segment"),
        "region",
        "signup_date",
        _money(F.col("lifetime_value")).alias("crm_lifetime_value"),
        "effective_from",
        "effective_to",
        "is_current",
    )


def transactions_enriched(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Each staged transaction with the attributes of its current customer."""
    return left_lookup(transactions, customers, "customer_id", CUSTOMER_ATTRIBUTES).select(
        "transaction_id",
        "customer_id",
        "transaction_amount",
        "transaction_at",
        "transaction_date",
        "transaction_hour",
        *CUSTOMER_ATTRIBUTES,
        safe_divide(F.col("transaction_amount"), F.col("crm_lifetime_value")).alias("txn_to_ltv_ratio"),
    )


def daily_revenue(
    transactions: DataFrame, customers: DataFrame, unique_transactions: bool = False
) -> DataFrame:
    """Revenue mart per day, segment and region."""
    keys = ["transaction_date", "customer_segment", "region"]
    amount = cents(F.col("transaction_amount"), strict=True)
    if unique_transactions:
        per_customer_day = transactions.groupBy("transaction_date", "customer_id").agg(
            F.count("transaction_id").alias("_n_ids"),
            F.count("transaction_amount").alias("_n_amounts"),
            sum_cents(amount).alias("_cents"),
        )
        members = attribute_sets(customers, "customer_id", ["customer_segment", "region"], "_versions")
        # A customer the dimension holds twice brings its money once per joined row, as after a
        # plain join, but its ids count once.
        weight = F.coalesce(F.col("_versions"), F.lit(1))
        grouped = (
            per_customer_day.join(members, "customer_id", "left")
            .groupBy(*keys)
            .agg(
                F.sum("_n_ids").alias("transaction_count"),
                F.count("customer_id").alias("active_customers"),
                F.sum(F.col("_n_amounts") * weight).alias("_n_amounts"),
                add_up_cents(F.col("_cents"), weight).alias("_cents"),
            )
        )
    else:
        joined = left_lookup(transactions, customers, "customer_id", ["customer_segment", "region"])
        grouped = joined.groupBy(*keys).agg(
            F.count_distinct("transaction_id").alias("transaction_count"),
            F.count_distinct("customer_id").alias("active_customers"),
            F.count("transaction_amount").alias("_n_amounts"),
            sum_cents(amount).alias("_cents"),
        )
    total = F.col("_cents")
    return grouped.select(
        *keys,
        "transaction_count",
        "active_customers",
        cents_as_money(total).alias("total_revenue"),
        cents_as_money(mean_cents(total, F.col("_n_amounts"))).alias("avg_transaction_value"),
        cents_as_money(mean_cents(total, F.col("active_customers"))).alias("revenue_per_customer"),
    )


def customer_360(
    transactions: DataFrame,
    customers: DataFrame,
    as_of: date | str | None = None,
    unique_transactions: bool = False,
) -> DataFrame:
    """Customer mart: behaviour per customer, then joined to its attributes.

    Summing first is the same as grouping the joined rows by customer and attributes: all rows of a
    customer meet the same dimension rows. The regrouping after the join needs no shuffle and only
    matters if the dimension holds a customer twice.
    """
    count_ids = F.count if unique_transactions else F.count_distinct
    behaviour = transactions.groupBy("customer_id").agg(
        count_ids("transaction_id").alias("_n_ids"),
        F.count("transaction_amount").alias("_n_amounts"),
        sum_cents(cents(F.col("transaction_amount"), strict=True)).alias("_cents"),
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
    )
    grouped = (
        behaviour.join(customers.select("customer_id", *CUSTOMER_ATTRIBUTES), "customer_id", "left")
        .groupBy("customer_id", *CUSTOMER_ATTRIBUTES)
        .agg(
            F.max("_n_ids").alias("total_transactions"),
            F.sum("_n_amounts").alias("_n_amounts"),
            add_up_cents(F.col("_cents")).alias("_cents"),
            F.min("first_purchase_date").alias("first_purchase_date"),
            F.max("last_purchase_date").alias("last_purchase_date"),
        )
    )
    spend = cents_as_money(F.col("_cents"))
    return grouped.select(
        "customer_id",
        *CUSTOMER_ATTRIBUTES,
        "total_transactions",
        spend.alias("actual_lifetime_spend"),
        cents_as_money(mean_cents(F.col("_cents"), F.col("_n_amounts"))).alias("avg_order_value"),
        "first_purchase_date",
        "last_purchase_date",
        active_span_days(F.col("first_purchase_date"), F.col("last_purchase_date")).alias(
            "active_span_days"
        ),
        value_tier(spend).alias("value_tier"),
        engagement_status(F.col("last_purchase_date"), as_of).alias("engagement_status"),
    )
