"""Left joins of facts to a dimension.

No broadcast hints: whether the dimension is small enough is left to Spark's size statistics
(``spark.sql.autoBroadcastJoinThreshold``) and to AQE.

A hot key on the fact side is split by AQE, but only where both inputs of the join come straight out
of a shuffle made for it. A dimension that a window or an aggregation has left partitioned by the key
would be joined in place and the hot key stay in one task. Joining on the key and a salt always gives
such shuffles: with one salt nothing is copied and AQE splits what it measures as skewed, with more
salts every key is spread over that many tasks and the dimension copied as often.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT = "_salt"


def left_lookup(
    facts: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str], salts: int = 1
) -> DataFrame:
    """Facts with the dimension's attributes; one ``key`` column, facts without a match kept."""
    salted = _salted_facts(facts, key, salts)
    return salted.join(_copies(dim.select(key, *attributes), salts), [key, _SALT], "left").drop(_SALT)


def _salted_facts(facts: DataFrame, key: str, salts: int) -> DataFrame:
    """The salt is a hash of the row, so that a retried task gives each row the same one."""
    hashed = [key]
    if salts > 1:
        hashed = [f"`{f.name}`" for f in facts.schema if not isinstance(f.dataType, _UNHASHABLE)]
    return facts.withColumn(_SALT, F.pmod(F.xxhash64(*hashed), F.lit(salts).cast("bigint")))


_UNHASHABLE = (T.MapType, T.VariantType)


def _copies(dim: DataFrame, salts: int) -> DataFrame:
    """Spark's size estimate does not know of the copies, so several are kept from being broadcast."""
    all_salts = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = dim.withColumn(_SALT, F.explode(all_salts))
    return copies if salts == 1 else copies.hint("merge")


def attribute_sets(dim: DataFrame, key: str, attributes: Sequence[str], versions: str) -> DataFrame:
    """The dimension with one row per key and distinct attribute values; ``versions`` counts its rows.

    Joined to facts that hold a key once per group, it keeps them that way: distinct keys become a
    plain count, and ``versions`` restores the weight of a key the dimension holds several times.
    """
    return dim.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias(versions))


def point_in_time_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    attributes: Sequence[str],
    valid_from: str = "effective_from",
    valid_to: str = "effective_to",
    salts: int = 1,
) -> DataFrame:
    """Facts with the attributes that held on date ``at``.

    Intervals are half-open and disjoint per key, so a fact matches at most one version and a key
    has at most one version per day. The equality on the key keeps this a partitioned join with the
    interval as residual condition, never a nested loop.
    """
    versions = history.filter(F.col(valid_from) < F.col(valid_to)).select(
        F.col(key).alias("_key"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        *attributes,
    )
    versions = _copies(versions, salts).withColumnRenamed(_SALT, "_version_salt")
    salted = _salted_facts(facts, key, salts)
    day = F.to_date(F.col(at))
    holds = (
        (F.col(key) == F.col("_key"))
        & (F.col(_SALT) == F.col("_version_salt"))
        & (day >= F.col("_from"))
        & (day < F.col("_to"))
    )
    helpers = ("_key", "_from", "_to", _SALT, "_version_salt")
    return salted.join(versions, holds, "left").drop(*helpers)


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    attributes: Sequence[str],
    valid_from: str = "effective_from",
    valid_to: str = "effective_to",
    salts: int = 1,
) -> DataFrame:
    """``point_in_time_join`` by one sort instead of a join: for keys with many versions.

    Facts and versions are united, sorted by key and day, and the last version is carried forward to
    the facts behind it. Each row passes the shuffle once, where a join on the key meets every fact of
    a key with all its versions. ``salts`` spreads the facts of each key over so many sorts, each with
    a copy of the versions. Facts without a key have nothing to wait for and are spread by themselves.
    """
    day = F.to_date(F.col(at))
    salted = _salted_facts(facts, key, salts)
    alone = F.xxhash64(*[f"`{f.name}`" for f in facts.schema if not isinstance(f.dataType, _UNHASHABLE)])
    version = F.struct(F.col(valid_to).alias("_to"), *[F.col(f"`{a}`") for a in attributes])
    versions = history.filter((F.col(valid_from) < F.col(valid_to)) & F.col(key).isNotNull())
    versions = _copies(versions, salts).select(
        F.col(key).alias("_key"), _SALT, F.to_date(F.col(valid_from)).alias("_day"), F.lit(0).alias("_kind"), version.alias("_version")
    )
    asking = salted.select(
        F.col(key).alias("_key"),
        F.when(F.col(key).isNull(), alone).otherwise(F.col(_SALT)).alias(_SALT),
        day.alias("_day"),
        F.lit(1).alias("_kind"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"),
    )
    # On one day the version comes first: it holds from that day on.
    so_far = Window.partitionBy("_key", _SALT).orderBy("_day", "_kind")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = versions.unionByName(asking, allowMissingColumns=True).withColumn(
        "_held", F.last("_version", ignorenulls=True).over(so_far)
    )
    holds = F.col("_day") < F.col("_held._to")
    found = [F.when(holds, F.col("_held").getField(a)).alias(a) for a in attributes]
    return held.filter("_kind = 1").select("_fact.*", *found)
