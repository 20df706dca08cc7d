"""Exact duplicates by a tree merge of sorted digest runs.

Texts are equal when identical after every run of ASCII whitespace became one space. A text is
represented by SHA-256, length and a second 64-bit hash of what it was normalised to; records merge
only when all three agree, so a digest collision would have to be one of all three.

Every partition of the digest table is a run. In each round the runs of ``fan`` partners meet: the
partner's address gets one more digit of the digest in place of one of its own, as in a binomial
exchange, and the sorted runs are merged to one that keeps the smallest identifier and the size of
each digest. Each side merges before it sends, so a text that holds a third of all rows is a few
records per partner from the first round on. After the last round every digest has one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import SPACE, by_ids, fresh, settle, text_of

KEY = ["sha", "size", "second"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", " ")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = F.col("norm")
    return (
        docs.select(F.col(f"`{id_col}`").alias("id"), normalised(text_of(text_col)).alias("norm"))
        .select(
            "id",
            F.unhex(F.sha2(norm, 256)).alias("sha"),
            F.octet_length(norm).cast("long").alias("size"),
            F.xxhash64(norm).alias("second"),
        )
    )


def merge_runs(digests: DataFrame, fan: int = 16) -> DataFrame:
    """One record per digest: its smallest (id, row) and its number of rows."""
    # Null ids come last, so a row without an id stays only if its text has no row with one.
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    runs = digests.select(*KEY, first.alias("first"), F.lit(1).cast("long").alias("n"), F.spark_partition_id().alias("node"))
    last = runs.agg(F.max("node")).first()[0]
    rounds, reach = 1, fan
    while last is not None and reach <= last:
        rounds, reach = rounds + 1, reach * fan
    digest_address = F.pmod(F.col("second"), F.lit(reach))
    for r in range(rounds):
        unit = fan**r
        digit = F.floor(digest_address / unit) % fan
        own = F.floor(F.col("node") / unit) % fan
        node = (F.col("node") + (digit - own) * unit).cast("long")
        runs = (
            runs.withColumn("node", node)
            .groupBy("node", *KEY)
            .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        )
    return runs.select(*KEY, F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "n")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = 16) -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept and text_sha256.

    Null texts count as empty. Of rows that share both id and text one stays. Of rows without an id
    one stays if no row with an id has the text. Texts of any length count whole. An empty table gives
    an empty one. Other columns are not read.
    """
    # The row number tells equal rows apart; stored, it can't change when a task is repeated.
    rows = settle(
        _digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests"
    )
    kept = merge_runs(rows, fan)
    return rows.join(kept, KEY).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_duplicates``."""
    marked = settle(exact_duplicates(docs, id_col, text_col, fan).select(
        F.col(f"`{id_col}`").alias("id"), "kept", "text_sha256"
    ), "marked")
    ids = marked.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("stay")
    )
    dropped = settle(ids.filter("id is not null and stay < n").select("id"), "dropped")
    rest = by_ids(docs.filter(F.col(f"`{id_col}`").isNotNull()), dropped, id_col, "left_anti")
    # An id can name both a row that stays and one that goes, and null ids can't be looked up.
    mixed = settle(ids.filter("id is null or (stay > 0 and stay < n)").select("id"), "mixed")
    if mixed.isEmpty():
        return rest
    again = docs.filter(F.col(f"`{id_col}`").isNull()).unionByName(
        by_ids(docs, mixed.filter("id is not null"), id_col, "left_semi")
    )
    picked, wanted = fresh(docs, "picked_of_row", "picked")
    chosen = (
        marked.filter("kept")
        .join(mixed.withColumnRenamed("id", "mixed_id"), F.col("id").eqNullSafe(F.col("mixed_id")))
        .select(F.struct(F.col("id"), F.col("text_sha256")).alias(wanted))
    )
    again = again.withColumn(
        picked, F.struct(F.col(f"`{id_col}`").alias("id"), F.sha2(normalised(text_of(text_col)), 256).alias("text_sha256"))
    )
    again = again.join(chosen, F.col(picked).eqNullSafe(F.col(wanted)), "left_semi")
    return rest.unionByName(again.dropDuplicates([picked]).drop(picked))
