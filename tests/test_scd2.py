from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators.enrich import point_in_time_join
from stratum.operators.scd2 import scd2_frame, scd2_merge
from tests.conftest import rows

END = date(9999, 12, 31)
SNAPSHOT = "customer_id string, segment string, value double"
DAYS = [date(2020, month, 1) for month in (1, 2, 3, 4)]


def snapshot(spark, data):
    return spark.createDataFrame(data, SNAPSHOT)


def merge(dim, snap, day, full=False):
    return scd2_merge(dim, snap, ["customer_id"], ["segment", "value"], day, full)


@pytest.fixture
def first(spark):
    return scd2_frame(
        snapshot(spark, [("same", "A", 1.0), ("changed", "A", 1.0), ("gone", "A", None)]), DAYS[0]
    )


@pytest.fixture
def second(spark):
    return snapshot(spark, [("same", "A", 1.0), ("changed", "B", 1.0), ("new", "C", None)])


def test_changed_new_and_gone(first, second):
    expected = [
        ("changed", "A", 1.0, DAYS[0], DAYS[1], False),
        ("changed", "B", 1.0, DAYS[1], END, True),
        ("gone", "A", None, DAYS[0], DAYS[1], False),
        ("new", "C", None, DAYS[1], END, True),
        ("same", "A", 1.0, DAYS[0], END, True),
    ]
    assert rows(merge(first, second, DAYS[1], full=True)) == expected
    expected[2] = ("gone", "A", None, DAYS[0], END, True)
    assert rows(merge(first, second, DAYS[1])) == expected


def test_same_snapshot_again_changes_nothing(first, second):
    once = merge(first, second, DAYS[1], full=True)
    again = merge(once, second, DAYS[2], full=True)
    assert rows(again) == rows(once)


def test_null_to_value_is_a_change_and_null_to_null_is_not(spark):
    dim = scd2_frame(snapshot(spark, [("a", None, None), ("b", None, None)]), DAYS[0])
    merged = merge(dim, snapshot(spark, [("a", None, None), ("b", "X", None)]), DAYS[1])
    assert rows(merged.groupBy("customer_id").count()) == [("a", 1), ("b", 2)]


def test_untracked_change_keeps_the_version(spark):
    dim = scd2_frame(snapshot(spark, [("a", "A", 1.0)]), DAYS[0])
    changed = snapshot(spark, [("a", "A", 2.0)])
    assert scd2_merge(dim, changed, ["customer_id"], ["segment"], DAYS[1]).count() == 1


def test_returning_key_opens_a_new_version(first, second, spark):
    closed = merge(first, second, DAYS[1], full=True)
    back = merge(closed, snapshot(spark, [("gone", "A", None)]), DAYS[2])
    assert rows(back.filter("customer_id = 'gone'")) == [
        ("gone", "A", None, DAYS[0], DAYS[1], False),
        ("gone", "A", None, DAYS[2], END, True),
    ]


def test_late_snapshot_is_refused(first, second):
    with pytest.raises(Exception, match="older than the open version"):
        merge(first, second, date(2019, 12, 31)).collect()


def test_copies_in_the_snapshot_do_not_multiply_versions(spark, first):
    copies = snapshot(spark, [("changed", "B", 1.0)] * 50 + [("changed", "C", 1.0), ("new", "N", 1.0)] * 2)
    merged = merge(first, copies, DAYS[1])
    current = merged.filter("is_current").select("customer_id", "segment")
    assert rows(current) == [("changed", "C"), ("gone", "A"), ("new", "N"), ("same", "A")]
    assert merged.count() == 5


def test_new_snapshot_column_is_added(first, second):
    merged = merge(first, second.withColumn("tier", F.lit("t")), DAYS[1])
    got = {(r.customer_id, r.segment): r.tier for r in merged.collect()}
    assert got == {
        ("same", "A"): None, ("changed", "A"): None, ("gone", "A"): None,
        ("changed", "B"): "t", ("new", "C"): "t",
    }


def test_point_in_time_is_half_open(spark, first, second):
    history = merge(first, second, DAYS[1], full=True)
    facts = spark.createDataFrame(
        [
            (1, "changed", "2020-01-31 23:59:59"),
            (2, "changed", "2020-02-01 00:00:00"),
            (3, "gone", "2020-02-01 00:00:00"),
            (4, "changed", "2019-12-31 23:59:59"),
            (5, "nobody", "2020-02-01 00:00:00"),
            (6, None, "2020-02-01 00:00:00"),
        ],
        "id int, customer_id string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    got = point_in_time_join(facts, history, "customer_id", "ts", ["segment"])
    assert got.columns == ["id", "customer_id", "ts", "segment"]
    assert {r.id: r.segment for r in got.collect()} == {
        1: "A", 2: "B", 3: None, 4: None, 5: None, 6: None,
    }


def test_version_opened_and_replaced_on_one_day_never_matches(spark, first, second):
    history = merge(first, second, DAYS[1])
    corrected = merge(history, snapshot(spark, [("changed", "Z", 1.0)]), DAYS[1])
    facts = spark.createDataFrame([("changed", DAYS[1])], "customer_id string, day date")
    got = point_in_time_join(facts, corrected, "customer_id", "day", ["segment"])
    assert [r.segment for r in got.collect()] == ["Z"]


states = st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["A", "B", None]), max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(states, min_size=2, max_size=4), st.booleans())
def test_intervals_are_disjoint_with_one_open_row_per_live_key(spark, snapshots, full):
    frames = [snapshot(spark, [(k, v, None) for k, v in state.items()]) for state in snapshots]
    dim = scd2_frame(frames[0], DAYS[0])
    for day, frame in zip(DAYS[1:], frames[1:]):
        dim = spark.createDataFrame(merge(dim, frame, day, full).collect(), dim.schema)
    by_key = {}
    for row in dim.collect():
        by_key.setdefault(row.customer_id, []).append(row)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.effective_from)
        for earlier, later in zip(versions, versions[1:]):
            assert earlier.effective_from < earlier.effective_to <= later.effective_from
        assert sum(r.is_current for r in versions) <= 1
        assert all(r.is_current == (r.effective_to == END) for r in versions)
    live = set(snapshots[-1]) if full else {key for state in snapshots for key in state}
    assert {key for key, versions in by_key.items() if versions[-1].is_current} == live
