"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import OPEN_END, resolve_date
from stratum.operators.dedupe import latest_per_key

FRAME_COLUMNS = ("effective_from", "effective_to", "is_current")


def scd2_frame(df: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Open a current version for every row."""
    return df.withColumns(
        {
            "effective_from": resolve_date(as_of),
            "effective_to": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )


def scd2_merge(
    dim: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str,
    full_snapshot: bool = False,
) -> DataFrame:
    """History after applying ``snapshot`` on day ``as_of``.

    A changed key gets its open version closed and a new one opened, a new key gets a version, and
    with ``full_snapshot`` a key missing from the snapshot is closed. Unchanged keys keep their row,
    so that applying a snapshot again changes nothing. Closed versions never enter the join. A column
    only the snapshot has is added, one only the history has is null in new versions.

    Keys must not be null. A key the snapshot repeats counts once, as its greatest row, so that
    copies cannot multiply versions; that step leaves the snapshot partitioned for the join.
    """
    day = resolve_date(as_of)
    dim = _with_new_columns(dim, snapshot)
    closed = dim.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    old = dim.filter("is_current").select(
        *[F.col(key) for key in keys], F.struct(*[_q(c) for c in dim.columns]).alias("_old")
    )
    opened = scd2_frame(latest_per_key(_shaped_like(snapshot, dim), keys, []), as_of)
    new = opened.select(
        *[F.col(key) for key in keys], F.struct(*[_q(c) for c in dim.columns]).alias("_new")
    )
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    differs = ~_all([_member("_old", c).eqNullSafe(_member("_new", c)) for c in tracked])
    changed = has_old & has_new & differs
    gone = has_old & ~has_new & F.lit(full_snapshot)
    ended = F.struct(
        *[
            _closing(day).alias(c)
            if c == "effective_to"
            else (F.lit(False) if c == "is_current" else _member("_old", c)).alias(c)
            for c in dim.columns
        ]
    )
    kept_version = F.when(changed | gone, ended).when(has_old, F.col("_old"))
    new_version = F.when(changed | (has_new & ~has_old), F.col("_new"))
    live = (
        old.join(new, list(keys), "full_outer")
        .select(F.explode(F.array(kept_version, new_version)).alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select("_row.*")
    )
    return closed.unionByName(live)


def scd2_change(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: date | str,
    full_snapshot: bool = False,
) -> tuple[DataFrame, list[date]]:
    """``scd2_merge`` for a history stored by ``effective_to``: new content of the partitions it touches,
    and these: the open one and the one of the closing day.

    Versions closed on other days are neither read nor written. Applied again after a job that was lost
    between the two partitions, it gives what that job would have left.
    """
    day = date.fromisoformat(str(as_of))
    parts = [OPEN_END, day]
    live = history.filter(F.col("effective_to").isin(*parts))
    merged = scd2_merge(live, snapshot, keys, tracked, as_of, full_snapshot)
    # A version that was closed before the open partition could be written is closed a second time.
    closed = merged.filter(F.col("effective_to") == F.lit(day)).distinct()
    return merged.filter(F.col("effective_to") != F.lit(day)).unionByName(closed), parts


def _with_new_columns(dim: DataFrame, snapshot: DataFrame) -> DataFrame:
    known = set(dim.columns)
    return dim.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in snapshot.schema if f.name not in known}
    )


def _shaped_like(snapshot: DataFrame, dim: DataFrame) -> DataFrame:
    present = set(snapshot.columns)
    return snapshot.select(
        *[
            (_q(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema
            if f.name not in FRAME_COLUMNS
        ]
    )


def _closing(day: Column) -> Column:
    """The closing day; a snapshot older than the open version would turn the interval around."""
    late = F.raise_error(F.lit("snapshot is older than the open version of a changed key"))
    return F.when(_member("_old", "effective_from") > day, late.cast("date")).otherwise(day)


def _member(struct: str, name: str) -> Column:
    return F.col(struct).getField(name)


def _all(conditions: Sequence[Column]) -> Column:
    joined = F.lit(True)
    for condition in conditions:
        joined = joined & condition
    return joined


def _q(name: str) -> Column:
    return F.col(f"`{name}`")
