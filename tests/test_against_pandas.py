"""Null, NaN and emptiness conventions of the rules, and flattening, held against pandas."""

import json
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators import quality as dq
from stratum.sources.payloads import flatten, unwrap_payloads
from stratum.sources.readers import read_source
from stratum.sources.registry import SourceSpec

NUMBERS = st.lists(
    st.one_of(st.none(), st.just(math.nan), st.sampled_from([-1.5, 0.0, 0.5, 2.0, 2e6])), max_size=6
)
WORDS = st.lists(st.sampled_from([None, "a", "b", "zz"]), max_size=4)
CALM = settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)



def number_rules():
    return [
        (dq.positive("c"), lambda s: (s > 0).all()),
        (dq.share_below("c", 1e6, 0.5), lambda s: (s < 1e6).mean() >= 0.5),
        (dq.non_negative("c"), lambda s: (s.fillna(0) >= 0).all()),
        (dq.at_least_rows(2), lambda s: len(s) >= 2),
    ]


def word_rules():
    return [
        (dq.unique("c"), lambda s: s.is_unique),
        (dq.complete("c"), lambda s: s.notna().all()),
        (dq.in_set("c", ["a", "b"]), lambda s: s.isin(["a", "b"]).all()),
    ]


def check(spark, values, kind, dtype, rules):
    series = pd.Series(values, dtype=dtype)
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    frame = dq.validation_frame("t", df, [rule for rule, _ in rules])
    got = {row["name"]: row["passed"] for row in frame.collect()}
    assert got == {rule.name: bool(expected(series)) for rule, expected in rules}


@CALM
@given(NUMBERS)
def test_number_rules(spark, values):
    check(spark, values, "double", "float64", number_rules())


@CALM
@given(WORDS)
def test_word_rules(spark, values):
    check(spark, values, "string", "object", word_rules())


@pytest.mark.parametrize(
    "records",
    [
        [{"a": 1, "b": {"c": "x", "d": {"e": 2.5}}}, {"a": 2}],
        [{"a": {"b": [1, 2], "c": None}}, {"a": {"b": [3]}, "z": "t"}],
        [{"k": True, "n": {"m": {"o": {"p": "deep"}}}}],
    ],
)
def test_flattening(spark, records):
    expected = pd.json_normalize(records)
    df = spark.createDataFrame([(json.dumps(records),)], "body string")
    got = flatten(unwrap_payloads(df, "body"))
    assert sorted(got.columns) == sorted(expected.columns)
    by_position = [row.asDict() for row in got.collect()]
    for row, (_, wanted) in zip(by_position, expected.iterrows()):
        for name, value in wanted.items():
            missing = not isinstance(value, list) and pd.isna(value)
            assert row[name] is None if missing else row[name] == value


def test_missing_value_tokens(spark, tmp_path):
    fields = ["", "NA", "n/a", "None", "null", "NaN", "-nan", "<NA>", "nil", "-", "0", " NA"]
    path = tmp_path / "t.csv"
    path.write_text("id,v\n" + "".join(f"{i},{v}\n" for i, v in enumerate(fields)), encoding="utf-8")
    expected = pd.read_csv(path, dtype=str)["v"]
    got = {int(r.id): r.v for r in read_source(spark, SourceSpec("s", "flat_file", str(path))).collect()}
    for i, value in enumerate(expected):
        assert (got[i] is None) == pd.isna(value), fields[i]
        assert got[i] is None or got[i] == value
