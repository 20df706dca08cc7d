"""Bag union by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; a column a part lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
