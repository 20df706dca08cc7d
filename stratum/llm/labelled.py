"""Bounded samples of labelled documents, held-out fold left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """A fifth of all ids, by the CRC-32 of the id as text. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled_ids(df: DataFrame, id_col: str, label_col: str | None, size: int) -> DataFrame:
    """At most ``size`` distinct training ids (with labels), in a pseudo-random fixed order.

    A label given twice counts as the larger one. The order by hash is a top-k per task, so no
    task and not the driver sees more than ``size`` rows.
    """
    label = F.lit(None).cast("int") if label_col is None else F.col(f"`{label_col}`").cast("int")
    rows = df.select(F.col(f"`{id_col}`").alias("sample_id"), label.alias("label")).filter(
        F.col("sample_id").isNotNull() & ~held_out("sample_id")
    )
    if label_col is not None:
        rows = rows.filter("label is not null").groupBy("sample_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("sample_id", F.lit("sample")), "sample_id").limit(size)
