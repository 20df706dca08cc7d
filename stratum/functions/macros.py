"""Reusable expressions: null-safe division, surrogate keys, cents to dollars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_KEY_PART = "_null_"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null for a zero or null denominator."""
    return F.try_divide(numerator, denominator)


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts joined with ``-``, nulls spelled out.

    Use string, integer, date or decimal parts: the text form of a double differs between engines.
    """
    texts = [F.coalesce(_column(part).cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def cents_to_dollars(amount: Column, precision: int = 2) -> Column:
    """Null for what is no number; a number beyond 10^25 stops the job, as none is turned into null."""
    exact = amount.try_cast("decimal(28,3)")
    number = amount.try_cast("double")
    too_wide = exact.isNull() & (F.abs(number) < float("inf"))
    refused = F.raise_error(F.concat(F.lit("cents beyond 10^25: "), amount.cast("string")))
    return F.round(F.when(too_wide, refused.cast("decimal(28,3)")).otherwise(exact) / F.lit(100), precision)


def _column(part: Column | str) -> Column:
    return F.col(part) if isinstance(part, str) else part
