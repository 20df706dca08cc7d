import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratum.llm import mixing, queries, sharding
from stratum.llm.common import number_rows


def test_rendezvous_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    before = {0: 1.0, 1: 2.0, 2: 1.0}
    both = sharding.assign_shards(keys, ["k"], before, "old")
    both = sharding.assign_shards(both, ["k"], before | {3: 1.0}, "new")
    moved = {(r["from"], r["to"]): r["rows"] for r in sharding.moved_rows(both, "old", "new").collect()}
    assert {to for _, to in moved} == {3}
    assert abs(sum(moved.values()) / 20_000 - 0.2) < 0.02
    share = Counter(r["old"] for r in both.collect())
    assert abs(share[1] / 20_000 - 0.5) < 0.02


def test_sharding_query(spark, sf_dir):
    rows = queries.op1_sharding(spark, sf_dir).collect()
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    slots = {}
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_are_gapless_over_many_buckets(spark):
    rows = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("bucket"))
    found = number_rows(rows, ["bucket"], ["k"], "n", rows_per_bucket=100).collect()
    for g in range(3):
        own = sorted(r["n"] for r in found if r["bucket"] == g)
        assert own == list(range(len(own)))


def test_one_key_with_a_third_of_the_rows_is_cut(spark):
    rows = spark.range(9_000).select(
        F.when(F.col("id") < 6_000, F.col("id")).when(F.col("id") < 7_500, 7).alias("k"),
        F.when(F.col("id") < 8_000, F.col("id") % 50).alias("shard_r"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("shard"),
        F.lit("old").alias("SLOT"),
    )
    numbered = number_rows(rows, ["shard"], ["k"], "slot", rows_per_bucket=100).collect()
    assert sorted(numbered[0].asDict()) == ["k", "shard", "shard_r", "slot"]
    plain = Counter((r["k"], r["shard_r"], r["shard"]) for r in rows.collect())
    assert Counter((r["k"], r["shard_r"], r["shard"]) for r in numbered) == plain
    assert max(plain.values()) > 300  # rows equal in every column, in a bucket for 100
    for shard in (None, 1, 2):
        assert sorted(r["slot"] for r in numbered if r["shard"] == shard) == list(range(3_000))


def test_windows_hold_pieces_of_a_hot_key(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.lit("s").alias("shard"))
    numbered = number_rows(rows, ["shard"], ["k"], "slot", rows_per_bucket=500)
    per_task = [n for n in numbered.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    assert sum(per_task) == 20_000 and max(per_task) < 10_000
    assert numbered.select("slot").distinct().count() == 20_000


def test_odd_rows_are_sharded(odd_documents, no_documents):
    weights = dict.fromkeys(range(4), 1.0)
    placed = sharding.add_slots(sharding.assign_shards(odd_documents, ["doc_id"], weights), "shard", ["doc_id"])
    rows = placed.collect()
    assert len(rows) == 12 and all(r["shard"] is not None and r["slot"] is not None for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert sharding.add_slots(sharding.assign_shards(no_documents, ["doc_id"], weights), "shard", ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous([F.col("k")], {0: 0.0})


@pytest.mark.parametrize("weights", [[1, 1], [5, 3, 1], [0.5] + [0.1] * 5, [9, 1, 1, 1, 1, 1, 1], [1]])
def test_frame_is_within_a_block_of_every_share(weights):
    slots = 210
    shares = mixing.whole_shares(weights, slots)
    taken = mixing.frame_schedule(shares, slots)
    assert sorted(s for own in taken for s in own) == list(range(slots))
    for share, own in zip(shares, taken, strict=True):
        have = 0
        for t in range(1, slots + 1):
            have += t - 1 in own
            assert abs(have - Fraction(share * t, slots)) < 1


def test_mix_keeps_all_rows_and_its_targets(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 2_000, "big").when(F.col("id") < 2_900, "mid").otherwise(None).alias("source"),
    )
    weights = {"big": 2.0, "mid": 1.0, None: 1.0}
    rows = sorted(mixing.mix(docs, weights=weights, block_rows=10).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(3_000))
    assert len({r["doc_id"] for r in rows}) == 3_000
    inside = [r for r in rows if r["in_mix"]]
    slots = sorted({(r["slot"], r["source"]) for r in inside}, key=lambda x: x[0])
    assert [s for s, _ in slots] == list(range(len(slots)))
    for source, share in (("big", 0.5), ("mid", 0.25), (None, 0.25)):
        have = 0
        for t, (_, s) in enumerate(slots, 1):
            have += s == source
            assert abs(have - share * t) < 1 + t / 1000
    later = mixing.mix(docs, weights={"mid": 1.0}, block_rows=10).collect()
    assert sorted(r["position"] for r in later) == list(range(3_000))
    assert max(r["position"] for r in later if r["source"] == "mid") == 899


def test_odd_rows_are_mixed(odd_documents, no_documents):
    assert sorted(r["position"] for r in mixing.mix(odd_documents, block_rows=2).collect()) == list(range(12))
    mixed = mixing.mixed_documents(odd_documents, block_rows=2)
    assert mixed.columns == odd_documents.columns
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, odd_documents.collect()))
    assert mixing.mix(no_documents).count() == 0
