from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators.dedupe import latest_per_key
from tests.conftest import rows

SCHEMA = "k string, at date, v string"
KEYS = st.sampled_from([None, "a", "b", "c"])


def test_latest_wins_and_nulls_order_last(spark):
    df = spark.createDataFrame(
        [("a", date(2020, 1, 1), "old"), ("a", date(2020, 1, 2), "new"), ("a", None, "undated")],
        SCHEMA,
    )
    assert rows(latest_per_key(df, ["k"], ["at"])) == [("a", date(2020, 1, 2), "new")]


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame(
        [(None, date(2020, 1, 1), "x"), (None, date(2020, 1, 2), "y"), ("b", None, "z")], SCHEMA
    )
    assert rows(latest_per_key(df, ["k"], ["at"])) == [
        ("b", None, "z"),
        (None, date(2020, 1, 2), "y"),
    ]


def test_ties_fall_to_the_remaining_columns(spark):
    tied = [("a", date(2020, 1, 1), value) for value in ("p", "r", "q")]
    for order in (tied, tied[::-1]):
        df = spark.createDataFrame(order, SCHEMA).repartition(3)
        assert rows(latest_per_key(df, ["k"], ["at"])) == [("a", date(2020, 1, 1), "r")]


def test_map_columns_are_left_out_of_the_tie_break(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1})], "k string, at int, m map<string,int>")
    assert latest_per_key(df, ["k"], ["at"]).count() == 1


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "`k.id` string, `at.day` int")
    assert rows(latest_per_key(df, ["k.id"], ["at.day"])) == [("a", 2)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(KEYS, st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=30))
def test_one_maximal_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k string, at int, v int")
    best = {}
    for key, at, value in data:
        best[key] = max(best.get(key, (-1, -1)), (at, value))
    expected = sorted(((k, *rank) for k, rank in best.items()), key=repr)
    assert rows(latest_per_key(df, ["k"], ["at"])) == expected
