"""Latest-record-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_row_num"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by ``tie_breakers``, nulls last.

    The default tie-breakers are all remaining orderable columns, so that the survivor does not
    depend on task order. Null keys form one group. ``row_number() = 1`` makes Spark put a
    WindowGroupLimit in front of the shuffle: each map task sends one row per key, also for a key
    that holds a large share of the table.
    """
    if tie_breakers is None:
        tie_breakers = default_tie_breakers(df, [*keys, *order_by])
    ranking = [_quoted(df, name).desc_nulls_last() for name in (*order_by, *tie_breakers)]
    window = Window.partitionBy(*[_quoted(df, key) for key in keys]).orderBy(*ranking)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def default_tie_breakers(df: DataFrame, used: Sequence[str]) -> list[str]:
    """All orderable columns but those already used."""
    return [f.name for f in df.schema if f.name not in used and _orderable(f.dataType)]


def _quoted(df: DataFrame, name: str):
    return df[f"`{name}`"]


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(field.dataType) for field in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))
