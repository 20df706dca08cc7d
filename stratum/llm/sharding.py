"""Weighted rendezvous hashing of record keys.

Every shard draws a score for a key from a hash of key and shard alone; the best score takes it.
Adding a shard moves a row only if the new shard's score is the best, so rows move into the new
shard and nowhere else, and a shard that leaves hands on its own rows only. The scores are drawn so
that a shard gets a share of the keys in proportion to its weight.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import number_rows


def _score(key: Sequence[Column], shard: int, weight: float) -> Column:
    """weight / -ln(u), u uniform in (0, 1) from 53 bits of the hash; larger wins."""
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 11).cast("double")
    u = (bits + 0.5) * 2.0**-53
    return F.lit(float(weight)) / -F.log(u)


def rendezvous(key: Sequence[Column], weights: Mapping[int, float]) -> Column:
    """The shard (int) of a key. Shards of weight 0 get nothing; ties go to the smaller shard."""
    live = sorted((s, w) for s, w in weights.items() if w > 0)
    if not live:
        raise ValueError("no shard has a weight above 0")
    scores = [(s, _score(key, s, w)) for s, w in live]
    # (best score, its shard): the larger score wins, then the smaller shard
    best = F.greatest(*[F.struct(x.alias("x"), F.lit(-s).alias("s")) for s, x in scores]) if len(scores) > 1 else None
    return F.lit(live[0][0]) if best is None else -best["s"]


def assign_shards(
    df: DataFrame, key: Sequence[str], weights: Mapping[int, float], out: str = "shard"
) -> DataFrame:
    """Add the shard of each row, without a shuffle.

    Rows of equal keys share a shard. Nulls in the key are values like any other, so a row without
    a key has a shard too. Texts are not read unless they are in the key. An empty table gives an
    empty one. A column named ``out`` is replaced.
    """
    return df.withColumn(out, rendezvous([F.col(f"`{k}`") for k in key], weights).cast("int"))


def add_slots(
    df: DataFrame, shard: str, order: Sequence[str], out: str = "slot", rows: int | None = None
) -> DataFrame:
    """Number the rows of each shard from 0 without gaps; see ``number_rows``.

    Rows that repeat an id (or have none) get numbers of their own, however many they are. A null
    shard is a shard. An empty table gives an empty one.
    """
    return number_rows(df, [shard], order, out, rows)


def moved_rows(df: DataFrame, before: str, after: str) -> DataFrame:
    """(from, to, rows) of the rows whose shard changes: what a resize has to copy."""
    return (
        df.filter(~F.col(f"`{before}`").eqNullSafe(F.col(f"`{after}`")))
        .groupBy(F.col(f"`{before}`").alias("from"), F.col(f"`{after}`").alias("to"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
