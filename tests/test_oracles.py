"""Every query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from stratum.workloads.oracles import all_oracles
from stratum.workloads.queries import all_queries
from tools.check_oracles import compare, connect


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert all_queries().keys() == all_oracles().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_twin(spark, connection, sf_dir, name):
    assert compare(spark, connection, sf_dir, name)[0].startswith("ok")


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name, condition, expected",
    [
        ("silver_transactions", "true", 43397),
        ("dedupe_latest", "true", 45832),
        ("scd2_merge", "true", 1635),
        ("scd2_merge", "is_current", 1363),
        ("scd2_merge_incremental", "is_current", 1489),
        ("point_in_time_join", "segment is null", 7458),
        ("engagement_status", "engagement_status = 'at_risk'", 296),
        ("value_tier", "value_tier = 'gold'", 897),
    ],
)
def test_known_counts(spark, name, condition, expected):
    df = contract.queries()[name](spark, "/root/testdata/sf0.01")
    assert df.filter(condition).count() == expected
