"""Date arithmetic with the clock passed in, so a re-run gives the same table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = date(9999, 12, 31)


def resolve_date(as_of: date | str | None) -> Column:
    """``as_of`` as a date literal; today where it is not given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def resolve_timestamp(moment: datetime | str | None) -> Column:
    return F.current_timestamp() if moment is None else F.lit(str(moment)).cast("timestamp")


def days_before(as_of: date | str | None, days: int) -> Column:
    return F.date_sub(resolve_date(as_of), days)


def tenure_days(signup: Column, as_of: date | str | None = None) -> Column:
    return F.datediff(resolve_date(as_of), signup)


def active_span_days(first: Column, last: Column) -> Column:
    return F.datediff(last, first)
