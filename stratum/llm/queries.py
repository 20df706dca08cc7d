"""The registered queries: each applies one operator, with its defaults, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    exact_dedup,
    fill_in_middle,
    hard_negatives,
    host_rules,
    html_extract,
    line_index,
    mixing,
    near_dedup,
    pii,
    rule_ensemble,
    sentence_pieces,
    sharding,
    toxicity,
)
from stratum.llm.common import table, text_of
from stratum.llm.labelled import held_out

SHARDS = 16


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text_of("text")) + 1).cast("long").alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.assign_shards(docs, ["doc_id"], dict.fromkeys(range(SHARDS), 1.0))
    placed = sharding.assign_shards(
        placed, ["doc_id"], dict.fromkeys(range(SHARDS + 1), 1.0), "grown_shard"
    )
    return sharding.add_slots(placed, "shard", ["doc_id"])


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_ensemble.train_quality(docs, table(spark, sf_dir, "labels"))
    return rule_ensemble.score_quality(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[_count_of(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
    )


def _count_of(kind: str):
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.host_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_rules.COUNTS, "base_failed", "host_rejected", "kept")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and samples of each text; round_trip says that their ids decode to it."""
    return sentence_pieces.sample_encodings(table(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_index.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle.restore(fill_in_middle.fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(vectors, anchors=F.col("id") % 100 == 0)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sharding,
            op2_mixing,
            op3_rule_ensemble,
            op4_pii,
            op5_exact_dedup,
            op6_host_rules,
            op7_near_dedup,
            op8_sentencepiece,
            op9_html_extract,
            op10_toxicity,
            op11_line_dedup,
            op12_fill_in_middle,
            op13_hard_negatives,
        )
    }
