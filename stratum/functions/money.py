"""Exact money aggregation.

Sums run over whole cents in a bigint: the result does not depend on the order in which tasks
finish, and a bigint buffer stays in the fast hash aggregate where a wide decimal would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column, strict: bool = False) -> Column:
    """Whole cents of an amount already rounded to two places.

    Null for null, NaN, infinity and anything beyond a bigint; with ``strict``, for decimals, what is
    beyond a bigint stops the job instead.
    """
    whole = F.round(amount * 100)
    return whole.cast("bigint") if strict else whole.try_cast("bigint")


def sum_cents(amount_cents: Column) -> Column:
    """Null over no values; stops the job rather than wrap around on bigint overflow."""
    overflow = F.raise_error(F.lit("sum of cents exceeds bigint")).cast("bigint")
    return F.when(F.count(amount_cents) > 0, F.coalesce(F.try_sum(amount_cents), overflow))


def add_up_cents(partial: Column, weight: Column | None = None) -> Column:
    """Second-level sum over partial sums, wide enough never to overflow."""
    amount = partial.cast("decimal(20,0)")
    if weight is not None:
        amount = (amount * weight).cast("decimal(22,0)")
    return F.sum(amount).cast("decimal(22,0)")


def mean_cents(total: Column, n: Column) -> Column:
    """Mean rounded half-up to a whole cent; null where n is 0."""
    quotient = F.try_divide(total.cast("decimal(22,0)"), n.cast("decimal(18,0)"))
    return F.round(quotient, 0).cast("decimal(22,0)")


def cents_as_money(amount_cents: Column) -> Column:
    return (amount_cents.cast("decimal(22,0)") / F.lit(100)).cast("decimal(24,2)")


def cents_as_double(amount_cents: Column) -> Column:
    return amount_cents.cast("double") / F.lit(100.0)
