"""Bronze -> silver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.dates import resolve_timestamp
from stratum.operators.dedupe import default_tie_breakers, latest_per_key
from stratum.operators.scd2 import scd2_frame
from stratum.sources.registry import DEFAULT_PARTITION_COLUMN


def cast_transactions(bronze: DataFrame) -> DataFrame:
    """Standard types; a value that does not parse becomes null."""
    return bronze.withColumns(
        {
            "transaction_id": F.col("transaction_id").cast("string"),
            "customer_id": F.col("customer_id").cast("string"),
            "amount": F.col("amount").try_cast("double"),
            "transaction_ts": F.col("transaction_ts").try_cast("timestamp"),
        }
    )


def keep_valid_transactions(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("amount") > 0).filter(F.col("customer_id").isNotNull())


def enrich_transactions(df: DataFrame, amount: str = "amount", ts: str = "transaction_ts") -> DataFrame:
    return df.withColumns(
        {
            "amount_usd": F.round(F.col(amount), 2),
            "transaction_date": F.to_date(F.col(ts)),
            "transaction_hour": F.hour(F.col(ts)),
        }
    )


def silver_transactions(
    bronze: DataFrame,
    processed_at: datetime | str | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Fact table: typed, valid, one row per transaction_id.

    Validity is decided before the dedupe, so an invalid late copy never hides a valid earlier one.
    """
    valid = keep_valid_transactions(cast_transactions(bronze))
    latest = latest_per_key(valid, ["transaction_id"], ["_ingested_at"], tie_breakers)
    return enrich_transactions(latest).withColumn("_processed_at", resolve_timestamp(processed_at))


@dataclass(frozen=True)
class FactChange:
    """New content of the partitions that a change in bronze touches."""

    rows: DataFrame
    dates: list[date | None]


def changed_facts(
    bronze: DataFrame,
    facts: DataFrame,
    days: Sequence[date],
    processed_at: datetime | str | None = None,
    tie_breakers: Sequence[str] | None = None,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
    stored_by: Column | None = None,
) -> FactChange:
    """What ``silver_transactions`` over all of ``bronze`` would change in ``facts``, the table it made
    before the rows of these landing ``days`` were new or replaced.

    A row of a landed day meets the stored row of its transaction: the later one wins, as in a full
    rebuild. A stored row that came from one of the days may be gone from bronze; then the next best
    row of its transaction is found in the other days. Only the partitions that hold an old or a new
    row of a touched transaction are read whole, and only they need to be written. Their dates come to
    the driver, one each. ``_processed_at`` of untouched rows stays.

    ``stored_by`` is what the table is partitioned by, if not ``transaction_date`` itself: an expression
    over it.
    """
    key = "transaction_id"
    day_of = F.col(f"`{partition_column}`")
    days = [F.lit(str(day)).cast("date") for day in days]
    in_days = F.coalesce(day_of.isin(*days), F.lit(False))
    candidates = keep_valid_transactions(cast_transactions(bronze.filter(day_of.isin(*days))))
    touched = _ids(candidates, key)
    # Winners of a changed day; a day landed for the first time has none.
    unsure = _ids(facts.filter(day_of.isin(*days)), key)
    if not unsure.isEmpty():
        rest = keep_valid_transactions(cast_transactions(bronze.filter(~in_days)))
        candidates = candidates.unionByName(_of_ids(rest, key, unsure))
        touched = touched.union(unsure)

    at = "transaction_date"
    stored_by = F.col(at) if stored_by is None else stored_by
    old_dates = _of_ids(facts.select(key, at), key, touched).select(at)
    new_dates = candidates.select(F.to_date("transaction_ts").alias(at))
    dates = [row[0] for row in old_dates.union(new_dates).select(stored_by).distinct().collect()]
    held = facts.filter(_among(stored_by, dates))
    return FactChange(_merged(candidates, held, in_days, key, resolve_timestamp(processed_at), tie_breakers), dates)


_DERIVED = ("amount_usd", "transaction_date", "transaction_hour", "_processed_at")
_ID = ["_of_id", "_no_id"]


def _keyed(df: DataFrame, key: str) -> DataFrame:
    """The key as two columns in which null is an id, too: they group and join by plain equality, so
    what is grouped by them is joined where it lies."""
    return df.withColumns({_ID[0]: F.coalesce(F.col(key), F.lit("")), _ID[1]: F.col(key).isNull()})


def _ids(df: DataFrame, key: str) -> DataFrame:
    return _keyed(df.select(key), key).select(_ID)


def _of_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows with one of the ids."""
    return _keyed(df, key).join(ids.distinct(), _ID, "left_semi").drop(*_ID)


def _merged(
    candidates: DataFrame,
    held: DataFrame,
    gone: Column,
    key: str,
    processed_at: Column,
    tie_breakers: Sequence[str] | None,
) -> DataFrame:
    """The held partitions after the best candidate of each key has met the stored rows of that key.

    A ``gone`` row only marks its key as touched. Rows of other keys stay as they are. Candidates and
    stored rows are shuffled by their key once: the join finds both where the windows left them.
    """
    names = candidates.columns
    values = [name for name in names if name != key]
    shared = [name for name in held.columns if name in names]
    own = [name for name in held.columns if name not in names or name in _DERIVED]
    if tie_breakers is None:
        tie_breakers = default_tie_breakers(candidates, [key, "_ingested_at"])
    ranking = ["_ingested_at", *tie_breakers]
    both = candidates.unionByName(held.select(*[f"`{name}`" for name in shared]), allowMissingColumns=True)
    kind = {field.name: field.dataType for field in both.schema}

    best = latest_per_key(_keyed(candidates, key).drop(key), _ID, ["_ingested_at"], tie_breakers)
    best = best.select(*_ID, *[F.col(f"`{name}`").cast(kind[name]).alias(name) for name in values], F.lit(True).alias("_new"))

    def kept(name: str) -> Column:
        return F.when(~F.col("_gone"), F.col(f"`{name}`"))

    stored = _keyed(held, key).withColumn("_gone", gone)
    stored = stored.select(
        *_ID,
        "_gone",
        *[(kept(name) if name in shared else F.lit(None)).cast(kind[name]).alias(f"_old_{name}") for name in values],
        *[kept(name).alias(f"_stored_{name}") for name in own],
    )
    group = Window.partitionBy(*_ID)
    order = [F.col(f"`_old_{name}`").desc_nulls_last() for name in ranking]
    stored = stored.withColumns(
        {"_nth": F.row_number().over(group.orderBy("_gone", *order)), "_any_gone": F.max("_gone").over(group)}
    )

    new, old_gone = F.coalesce(F.col("_new"), F.lit(False)), F.coalesce(F.col("_gone"), F.lit(True))
    of_new = F.struct(*[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(ranking)])
    of_old = F.struct(*[F.col(f"`_old_{name}`").alias(f"_{i}") for i, name in enumerate(ranking)])
    met = best.join(stored, _ID, "full_outer").withColumns(
        {
            "_touched": new | F.coalesce(F.col("_any_gone"), F.lit(False)),
            "_wins": new & (old_gone | (of_new >= of_old)),  # nulls are the least in structs
        }
    )
    first = (F.coalesce(F.col("_nth"), F.lit(1)) == 1) & (F.col("_wins") | ~old_gone)
    rows = met.filter(~F.col("_touched") | first).withColumns(
        {
            key: F.when(~F.col(_ID[1]), F.col(_ID[0])),
            **{name: F.when(F.col("_wins"), F.col(f"`{name}`")).otherwise(F.col(f"`_old_{name}`")) for name in values},
        }
    )
    made = enrich_transactions(rows).withColumn("_processed_at", processed_at)

    def final(name: str) -> Column:
        again = F.col(name) if name in _DERIVED else F.lit(None)
        as_it_is = F.col(f"`_stored_{name}`") if name in own else F.lit(None)
        return F.when(F.col("_touched"), again).otherwise(as_it_is).alias(name)

    return made.select(
        *[F.col(f"`{name}`") for name in names if name not in _DERIVED],
        *[final(name) for name in _DERIVED],
        *[final(name) for name in own if name not in _DERIVED],
    )


def _among(column: Column, values: Sequence) -> Column:
    some = column.isin([value for value in values if value is not None])
    return some | column.isNull() if None in values else some


def silver_customers(
    bronze: DataFrame,
    as_of: date | str | None = None,
    processed_at: datetime | str | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Dimension snapshot: typed, the latest row per customer, framed as current versions."""
    typed = bronze.withColumns(
        {
            "customer_id": F.col("customer_id").cast("string"),
            "lifetime_value": F.col("lifetime_value").try_cast("double"),
            "signup_date": F.col("signup_date").try_cast("date"),
        }
    ).filter(F.col("customer_id").isNotNull())
    latest = latest_per_key(typed, ["customer_id"], ["_ingested_at"], tie_breakers)
    return scd2_frame(latest, as_of).withColumn("_processed_at", resolve_timestamp(processed_at))
