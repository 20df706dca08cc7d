"""Tables, scratch copies, gapless numbering and id filters shared by the operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path

#: Whitespace and words as the operators count them: six ASCII characters, nothing else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Ids up to this number (8 bytes each) may be sent to every executor; beyond it they are shuffled.
MAX_BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, and no lineage behind it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with a suffix if the frame has such a column (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    return [n if n.lower() not in taken else f"{n}_{uuid.uuid4().hex[:8]}" for n in names]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package along, so workers find it wherever they start.

    The archive is made on the driver and handed out by Spark, once per application.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = shutil.make_archive(
            os.path.join(folder, f"{os.path.basename(package)}-package"),
            "zip",
            os.path.dirname(package),
            os.path.basename(package),
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package sent along."""
    ship_package(df.sparkSession)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks and would hold on to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_of(column: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once; an outer array named in a lambda is computed for
    every element otherwise."""
    return F.element_at(F.transform(F.array(value), body), 1)


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    rows: int | None = None,
    rows_per_bucket: int = 20_000,
) -> DataFrame:
    """Number the rows of each group from 0 without gaps; no task sorts a whole group.

    Rows are dealt by hash to buckets of about ``rows_per_bucket``. The counts per bucket give the
    number each bucket starts from, and a window numbers the rows inside it. So the numbering
    follows (bucket, order) and depends on the rows alone if ``order`` is a total order. ``rows``
    spares the counting job. Null group values are a group. Rows equal in all of ``order`` share a
    bucket and are numbered arbitrarily among themselves; where they make it over four times too
    large it is cut, see ``_number_heavy``. An empty table gives an empty one. A column named ``out``
    is replaced.
    """
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()])
    if rows is None:
        rows = df.count()
    buckets = max(1, -(-rows // rows_per_bucket))
    bucket, count, start, key = fresh(df, "bucket", "bucket_rows", "bucket_start", "bucket_key")
    key_r, bucket_r, *groups_r = fresh(df, f"{key}_r", f"{bucket}_r", *[f"{g}_r" for g in group])
    keys = [F.col(f"`{g}`") for g in group]
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order, F.lit(17)), F.lit(buckets)))
    # One shuffle key for both sides, so the counted and the numbered rows meet without another.
    dealt = dealt.withColumn(key, F.xxhash64(*keys, F.col(bucket)))
    sizes = dealt.groupBy(key, bucket, *keys).agg(F.count(F.lit(1)).alias(count))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(start, F.coalesce(F.sum(count).over(before), F.lit(0))).select(
        F.col(key).alias(key_r),
        F.col(bucket).alias(bucket_r),
        *[k.alias(g) for k, g in zip(keys, groups_r, strict=True)],
        count,
        start,
    )
    starts = settle(starts, "bucket-starts")
    on = (F.col(key) == F.col(key_r)) & (F.col(bucket) == F.col(bucket_r))
    for k, g in zip(keys, groups_r, strict=True):
        on = on & k.eqNullSafe(F.col(f"`{g}`"))

    def numbered(part: DataFrame) -> DataFrame:
        inside = Window.partitionBy(key, bucket, *keys).orderBy(*order)
        part = part.withColumn(out, F.row_number().over(inside).cast("long"))
        return part.join(starts, on).select(
            *[F.col(f"`{c}`") for c in df.columns],
            (F.col(start) + F.col(out) - 1).alias(out),
        )

    heavy = starts.filter(F.col(count) > 4 * rows_per_bucket)
    n_heavy, rows_heavy = heavy.agg(F.count(F.lit(1)), F.sum(count)).first()
    if not n_heavy:
        return numbered(dealt)
    heavy = F.broadcast(heavy) if n_heavy <= MAX_BROADCAST_IDS else heavy.hint("merge")
    hot = dealt.join(heavy, on).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.struct(*[k.alias(f"g{i}") for i, k in enumerate(keys)], F.col(bucket).alias("b")).alias(bucket),
        F.ceil(F.col(count) / rows_per_bucket).alias(count),
        start,
    )
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows_heavy // 1_000_000))
    cut = _number_heavy(hot, df.columns, bucket, count, start, order, out, rows_per_bucket, parts)
    return numbered(dealt.join(heavy, on, "left_anti")).unionByName(cut)


def _number_heavy(
    hot: DataFrame,
    columns: Sequence[str],
    bucket: str,
    pieces: str,
    start: str,
    order: Sequence[str | Column],
    out: str,
    chunk: int,
    parts: int,
) -> DataFrame:
    """The rows of buckets that hold many rows of equal order, numbered from the start of their bucket.

    The hash of the whole row deals the rows of a bucket to pieces. Rows equal in every column are
    counted before the shuffle and take a run of numbers; it is handed out in chunks by ``parts``
    tasks. (Columns of maps, which Spark can't group, can't be numbered here.)
    """
    content = [F.col(f"`{c}`") for c in columns]
    copies, hashed, piece, first, at = fresh(hot, "copies", "row_hash", "piece", "first_number", "chunk_at")
    bucket_p, piece_p, piece_start = fresh(hot, "bucket_of_piece", "piece_no", "piece_start")
    rows = hot.groupBy(*content, bucket, pieces, start).agg(F.count(F.lit(1)).alias(copies))
    rows = rows.withColumn(hashed, F.xxhash64(*content, F.lit(29)))
    rows = settle(rows.withColumn(piece, F.pmod(F.col(hashed), F.col(pieces))), "heavy-rows")
    before = Window.partitionBy(bucket).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(bucket, piece).agg(F.sum(copies).alias(piece_start))
    sizes = sizes.withColumn(piece_start, F.coalesce(F.sum(piece_start).over(before), F.lit(0))).select(
        F.col(bucket).alias(bucket_p), F.col(piece).alias(piece_p), piece_start
    )
    inside = Window.partitionBy(bucket, piece).orderBy(*order, hashed).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn(first, F.coalesce(F.sum(copies).over(inside), F.lit(0))).join(
        sizes, (F.col(bucket) == F.col(bucket_p)) & (F.col(piece) == F.col(piece_p))
    )
    placed = placed.select(
        *content,
        copies,
        (F.col(start) + F.col(piece_start) + F.col(first)).alias(first),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(chunk).cast("long"))).alias(at),
    )
    last = F.least(F.col(at) + chunk, F.col(copies)) - 1
    return placed.repartition(parts, first, at).select(
        *content, first, F.explode(F.sequence(F.col(at), last)).alias(at)
    ).select(*content, (F.col(first) + F.col(at)).alias(out))


def by_ids(df: DataFrame, ids: DataFrame, column: str, how: str) -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) the rows whose ``column`` is among ``ids``.

    ``ids`` is a stored table of one column. Few ids are broadcast, so texts need no shuffle.
    Null never matches.
    """
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    else:  # a side of unknown size is never broadcast
        ids = ids.hint("merge")
    key = ids.columns[0]
    other = ids.select(F.col(f"`{key}`").alias(f"{key}_{uuid.uuid4().hex[:8]}"))
    return df.join(other, F.col(f"`{column}`") == F.col(other.columns[0]), how)
