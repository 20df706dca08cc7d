"""Column functions: no I/O, no actions, no Python UDFs."""

from stratum.functions.dates import active_span_days, days_before, resolve_date, tenure_days
from stratum.functions.macros import cents_to_dollars, safe_divide, surrogate_key
from stratum.functions.money import (
    add_up_cents,
    cents,
    cents_as_money,
    cents_as_double,
    mean_cents,
    sum_cents,
)
from stratum.functions.tiers import (
    ENGAGEMENT_STATUSES,
    TIER_FLOORS,
    VALUE_TIERS,
    engagement_status,
    value_tier,
)

__all__ = [
    "ENGAGEMENT_STATUSES",
    "TIER_FLOORS",
    "VALUE_TIERS",
    "active_span_days",
    "add_up_cents",
    "cents",
    "cents_as_double",
    "cents_as_money",
    "cents_to_dollars",
    "days_before",
    "engagement_status",
    "mean_cents",
    "resolve_date",
    "safe_divide",
    "sum_cents",
    "surrogate_key",
    "tenure_days",
    "value_tier",
]
