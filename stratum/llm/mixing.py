"""Interleave sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows. With weight w (its share of all slots) its j-th block may
not run before slot floor(j / w) and must have run by slot ceil((j + 1) / w). Scheduling the block
with the earliest deadline among those released keeps every source within less than one block of
its share at every slot.

With weights that are whole shares of a frame of N slots all windows repeat every N slots, so one
frame is scheduled on the driver and the slot of every block of any corpus follows by arithmetic.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stratum.llm.common import fresh, number_rows, settle

MAX_SOURCES = 1_000_000
MAX_BROADCAST_ROWS = 100_000
SLOTS_PER_BUCKET = 4096


def whole_shares(weights: list[float], slots: int) -> list[int]:
    """Shares of ``slots`` in proportion to the weights, at least 1 each, by largest remainder."""
    total = sum(Fraction(w) for w in weights)
    spare = slots - len(weights)
    exact = [Fraction(w) * spare / total for w in weights]
    shares = [1 + int(x) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in by_rest[: slots - sum(shares)]:
        shares[i] += 1
    return shares


def frame_schedule(shares: list[int], slots: int) -> list[list[int]]:
    """For each source, the slots of its blocks within one frame, earliest deadline first."""
    if sum(shares) != slots:
        raise ValueError("the shares don't fill the frame")
    # Blocks wait by release time, then by deadline; one of each source is in a heap at a time.
    waiting = [(0, i, 0) for i in range(len(shares))]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    taken: list[list[int]] = [[] for _ in shares]
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * slots // shares[i]), i, j))
        deadline, i, j = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a block missed its deadline")
        taken[i].append(slot)
        if j + 1 < shares[i]:
            heapq.heappush(waiting, ((j + 1) * slots // shares[i], i, j + 1))
    return taken


def _targets(counts: list, weights: Mapping[str | None, float] | None, temperature: float) -> dict:
    if weights is None:
        return {r["source"]: float(r["n"]) ** temperature for r in counts}
    return {r["source"]: float(weights.get(r["source"], 0.0)) for r in counts}


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    block_rows: int = 64,
    resolution: int = 4096,
) -> DataFrame:
    """Per row: id, source, target weight, block, slot, position and in_mix.

    ``weights`` names the target weight of each source; without it a source weighs its row count to
    the power of ``temperature``. Targets are met as whole shares of a frame of ``resolution`` slots
    (more if there are many sources), that is to about 1 / resolution. ``position`` numbers all
    rows from 0 without gaps in the order of the mix. ``in_mix`` is true as long as no source is
    used up: up to there every source is within one block of its share. After it the remaining
    sources go on in their own slots, and no row is dropped.

    A null source is a source. Sources without a weight come last, with slot null. Rows of a source
    are in a fixed pseudo-random order of their ids; rows that repeat an id stay next to each other
    in no particular order. An empty table gives an empty one.
    """
    light = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source")
    )
    counted = light.groupBy("source").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; mix groups of them instead")
    spark = docs.sparkSession
    targets = _targets(counted, weights, temperature)
    mixed = sorted((s for s, w in targets.items() if w > 0), key=lambda s: (s is None, s or ""))
    slots = max(resolution, 4 * len(mixed))
    shares = whole_shares([targets[s] for s in mixed], slots) if mixed else []
    taken = frame_schedule(shares, slots) if mixed else []
    rows = {r["source"]: r["n"] for r in counted}
    ends = [_slot(-(-rows[s] // block_rows), taken[i], slots) for i, s in enumerate(mixed)]
    horizon = min(ends, default=0)
    number = {s: i for i, s in enumerate(mixed)}
    sources = spark.createDataFrame(
        [(s, number.get(s), shares[number[s]] if s in number else None, shares[number[s]] / slots if s in number else 0.0) for s in rows],
        StructType(
            [
                StructField("name", StringType()),
                StructField("no", IntegerType()),
                StructField("share", IntegerType()),
                StructField("weight", DoubleType()),
            ]
        ),
    )
    pattern = spark.createDataFrame(
        [(i, k, s) for i, own in enumerate(taken) for k, s in enumerate(own)],
        StructType([StructField("of", IntegerType()), StructField("k", LongType()), StructField("at", LongType())]),
    )
    if slots <= MAX_BROADCAST_ROWS:  # both tables have at most this many rows
        sources, pattern = F.broadcast(sources), F.broadcast(pattern)
    row = number_rows(
        light.withColumn("shuffled", F.xxhash64("id")), ["source"], ["shuffled", "id"], "row", sum(rows.values())
    )
    placed = (
        row.join(sources, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("block", F.floor(F.col("row") / block_rows))
        .withColumn("j", F.col("block") % F.col("share"))
        .join(pattern, (F.col("no") == F.col("of")) & (F.col("j") == F.col("k")), "left")
        .select(
            "id",
            "source",
            "weight",
            "block",
            (F.floor(F.col("block") / F.col("share")) * slots + F.col("at")).alias("slot"),
            F.pmod(F.col("row"), F.lit(block_rows)).alias("inside"),
            # Sources without a weight follow in blocks, one source after the other.
            F.when(F.col("no").isNull(), F.xxhash64("source")).alias("tail"),
        )
    )
    placed = settle(placed, "placed")
    starts = _block_starts(placed)
    out = placed.join(
        starts,
        F.col("slot").eqNullSafe(F.col("slot_r"))
        & F.col("tail").eqNullSafe(F.col("tail_r"))
        & (F.coalesce("slot", F.col("block")) == F.col("order_r")),
    )
    return out.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "weight",
        "block",
        "slot",
        (F.col("start") + F.col("inside")).alias("position"),
        F.coalesce(F.col("slot") < horizon, F.lit(False)).alias("in_mix"),
    )


def _slot(block: int, taken: list[int], slots: int) -> int:
    return block // len(taken) * slots + taken[block % len(taken)]


def _block_starts(placed: DataFrame) -> DataFrame:
    """The position at which each block starts: sums over buckets of slots, then inside a bucket."""
    order = F.coalesce("slot", F.col("block"))
    blocks = placed.groupBy("slot", "tail", order.alias("order_r")).agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.withColumn("bucket", F.floor(F.col("order_r") / SLOTS_PER_BUCKET))
    sizes = blocks.groupBy("tail", "bucket").agg(F.sum("n").alias("bucket_n"))
    all_before = Window.orderBy(F.col("tail").asc_nulls_first(), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("tail").alias("tail_b"),
        F.col("bucket").alias("bucket_b"),
        F.coalesce(F.sum("bucket_n").over(all_before), F.lit(0)).alias("bucket_start"),
    )
    inside = (
        Window.partitionBy("tail", "bucket").orderBy("order_r").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return blocks.join(
        sizes, F.col("tail").eqNullSafe(F.col("tail_b")) & (F.col("bucket") == F.col("bucket_b"))
    ).select(
        F.col("slot").alias("slot_r"),
        F.col("tail").alias("tail_r"),
        "order_r",
        (F.col("start") + F.col("bucket_start")).alias("start"),
    )


def with_positions(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    slot: str = "slot",
    position: str = "position",
    **options,
) -> DataFrame:
    """All rows of ``docs`` with all their columns, their slot and their position in the mix.

    Rows that share id and source take one place; null ids and sources are values like others. Texts
    are not read. An empty table gives an empty one. Columns named as the new ones (in any letter case)
    are replaced.
    """
    taken = {slot.lower(), position.lower()}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    units = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source")).distinct()
    placed = mix(units, "id", "source", **options).select(
        F.struct("id", "source").alias("unit"), "slot", "position"
    )
    unit, other = fresh(docs, "unit_of_row", "unit_in_mix")
    keyed = docs.withColumn(
        unit, F.struct(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"))
    )
    placed = placed.select(
        F.col("unit").alias(other), F.col("slot").alias(slot), F.col("position").alias(position)
    )
    return keyed.join(placed, F.col(unit).eqNullSafe(F.col(other))).drop(unit, other)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """All rows of ``docs`` with all their columns, sorted by their position in the mix.

    Rows that share id and source take one place and stay together.
    """
    slot, position = fresh(docs, "slot_in_mix", "position_in_mix")
    placed = with_positions(docs, id_col, source_col, slot, position, **options)
    return placed.orderBy(position).drop(slot, position)
