"""Customer classification rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.dates import days_before

# Spend floors from the highest tier down, the tier below all floors, and statuses.
TIER_FLOORS = (("platinum", 10000), ("gold", 5000), ("silver", 1000))
BASE_TIER = "bronze"
VALUE_TIERS = ("platinum", "gold", "silver", "bronze")
ENGAGEMENT_STATUSES = ("active", "at_risk", "churned")
CHURNED_AFTER_DAYS = 90
AT_RISK_AFTER_DAYS = 30


def value_tier(
    spend: Column,
    floors: tuple[tuple[str, int], ...] = TIER_FLOORS,
    base: str = BASE_TIER,
) -> Column:
    """First floor reached, highest first; null spend gets the base tier."""
    reached = [F.when(spend >= floor, F.lit(tier)) for tier, floor in floors]
    return F.coalesce(*reached, F.lit(base))


def engagement_status(last_seen: Column, as_of: date | str | None = None) -> Column:
    """Strictly older than 90 / 30 days; null counts as active."""
    return (
        F.when(last_seen < days_before(as_of, CHURNED_AFTER_DAYS), "churned")
        .when(last_seen < days_before(as_of, AT_RISK_AFTER_DAYS), "at_risk")
        .otherwise("active")
    )
