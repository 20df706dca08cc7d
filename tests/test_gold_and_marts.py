"""The pre-aggregating plans against loops over single sales, and known results."""

import math
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.plans import gold, marts
from tests.conftest import rows

AS_OF = "2020-06-01"
FACT = (
    "transaction_id string, customer_id string, amount_usd double, transaction_ts timestamp,"
    " transaction_date date, transaction_hour int, _processed_at timestamp"
)
DIM = (
    "customer_id string, segment string, region string, signup_date date, lifetime_value double,"
    " effective_from date, effective_to date, is_current boolean"
)
D1, D2 = date(2020, 1, 1), date(2020, 5, 20)


def fact(tid, customer, amount, day=D1):
    ts = day and datetime(day.year, day.month, day.day, 7)
    return (tid, customer, amount, ts, day, 7, datetime(2020, 1, 3))


def dim(customer, segment, region="R", value=100.0, current=True):
    return (customer, segment, region, D1, value, D1, date(9999, 12, 31), current)


FACTS = [
    fact("t1", "a", 1.01), fact("t2", "a", 2.02), fact("t3", "a", 5.0, D2),
    fact("t4", "b", 0.005 + 0.1), fact("t5", "twice", 3.0), fact("t6", "split", 4.0),
    fact("t7", "orphan", 9.99), fact("t8", "orphan", 10000.0, D2), fact("t9", "a", 7.0, None),
    fact(None, "b", 1.0),
]
REPEATED = [*FACTS, fact("t1", "a", 1.01), fact("t1", "b", 1.0), fact("t3", "orphan", 2.0, D2)]
CUSTOMERS = [
    dim("a", "X"), dim("b", "Y", None, 0.0), dim("idle", "X"), dim("twice", "X"), dim("twice", "X"),
    dim("split", "X"), dim("split", "Y"), dim("a", "Z", current=False), dim("nulls", None, None, None),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(FACTS, FACT)


@pytest.fixture(scope="module")
def repeated(spark):
    return spark.createDataFrame(REPEATED, FACT)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, DIM)


def staged(facts, customers, start="2000-01-01"):
    return marts.stg_transactions(facts, start), marts.stg_customers(customers)


def cents_of(amount):
    return int(Decimal(repr(amount)).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)


def dollars(cents, share=1):
    """A whole number of cents, or a share of it to the nearest cent; None of nobody."""
    if share == 0:
        return None
    return (Decimal(cents) / share / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)


def sales(fact_rows, dim_rows, group):
    """What each group sold: (id, customer, cents, day) once per version its customer has."""
    found = defaultdict(list)
    for tid, customer, amount, _, day, *_ in fact_rows:
        versions = [d for d in dim_rows if d[0] == customer]
        for version in versions or [(customer, None, None, None, None)]:
            found[group(day, version)].append((tid, customer, cents_of(amount), day))
    return found


def known(values):
    return set(values) - {None}


def expected_daily(fact_rows, dim_rows):
    dated = [row for row in fact_rows if row[4]]
    out = []
    for group, sold in sales(dated, [d for d in dim_rows if d[-1]], lambda day, c: (day, c[1], c[2])).items():
        ids, buyers, cents, _ = map(list, zip(*sold))
        mean, each = dollars(sum(cents), len(cents)), dollars(sum(cents), len(known(buyers)))
        out.append((*group, len(known(ids)), len(known(buyers)), dollars(sum(cents)), mean, each))
    return sorted(out, key=repr)


def expected_360(fact_rows, dim_rows):
    dated = [row for row in fact_rows if row[4]]
    out = []
    for group, sold in sales(dated, [d for d in dim_rows if d[-1]], lambda day, c: tuple(c[:5])).items():
        ids, _, cents, days = map(list, zip(*sold))
        value = None if group[4] is None else dollars(cents_of(group[4]))
        spent = (dollars(sum(cents)), dollars(sum(cents), len(cents)))
        out.append((*group[:4], value, len(known(ids)), *spent, min(days), max(days)))
    return sorted(out, key=repr)


SPEND = [
    "customer_id", *marts.CUSTOMER_ATTRIBUTES, "total_transactions", "actual_lifetime_spend",
    "avg_order_value", "first_purchase_date", "last_purchase_date",
]


def test_daily_revenue_of_known_sales(facts, customers):
    """t5 counts twice for its customer is there twice, t6 in both segments of its customer."""
    money = lambda *texts: tuple(map(Decimal, texts))
    for unique in (True, False):
        assert rows(marts.daily_revenue(*staged(facts, customers), unique_transactions=unique)) == sorted(
            [
                (D1, "X", "R", 4, 3, *money("13.03", "2.61", "4.34")),
                (D1, "Y", None, 1, 1, *money("1.11", "0.56", "1.11")),
                (D1, "Y", "R", 1, 1, *money("4.00", "4.00", "4.00")),
                (D1, None, None, 1, 1, *money("9.99", "9.99", "9.99")),
                (D2, "X", "R", 1, 1, *money("5.00", "5.00", "5.00")),
                (D2, None, None, 1, 1, *money("10000.00", "10000.00", "10000.00")),
            ],
            key=repr,
        )


@pytest.mark.parametrize("unique", [True, False])
def test_daily_revenue_equals_a_loop_over_sales(facts, customers, unique):
    got = marts.daily_revenue(*staged(facts, customers), unique_transactions=unique)
    assert rows(got) == expected_daily(FACTS, CUSTOMERS)


def test_daily_revenue_counts_repeated_ids_once(repeated, customers):
    assert rows(marts.daily_revenue(*staged(repeated, customers))) == expected_daily(REPEATED, CUSTOMERS)


@pytest.mark.parametrize("unique", [True, False])
def test_customer_360_equals_a_loop_over_sales(facts, customers, unique):
    got = marts.customer_360(*staged(facts, customers), as_of=AS_OF, unique_transactions=unique)
    assert rows(got.select(*SPEND)) == expected_360(FACTS, CUSTOMERS)


def test_customer_360_counts_repeated_ids_once(repeated, customers):
    got = marts.customer_360(*staged(repeated, customers), as_of=AS_OF).select(*SPEND)
    assert rows(got) == expected_360(REPEATED, CUSTOMERS)


def test_customer_360_keeps_orphans_and_omits_idle(facts, customers):
    got = {
        r.customer_id: r
        for r in marts.customer_360(*staged(facts, customers), as_of=AS_OF).collect()
    }
    assert "idle" not in got
    orphan = got["orphan"]
    assert orphan.customer_segment is None
    assert orphan.value_tier == "platinum"
    assert orphan.engagement_status == "active"
    assert orphan.active_span_days == (D2 - D1).days
    assert got["b"].engagement_status == "churned"


@pytest.mark.parametrize("current_only", [True, False])
def test_revenue_by_segment_of_known_sales(facts, customers, current_only):
    # t4 is half a cent off and never leaves silver like that
    clean = facts.filter("transaction_id != 't4' or transaction_id is null")
    got = gold.revenue_by_segment(clean, customers, current_only=current_only).drop("_processed_at")
    expected = [
        (None, "X", "R", 1, 1, 7.0, 7.0),
        (D1, "X", "R", 5, 3, 13.03, 2.61),
        (D1, "Y", None, 0, 1, 1.0, 1.0),
        (D1, "Y", "R", 1, 1, 4.0, 4.0),
        (D1, None, None, 1, 1, 9.99, 9.99),
        (D2, "X", "R", 1, 1, 5.0, 5.0),
        (D2, None, None, 1, 1, 10000.0, 10000.0),
    ]
    if not current_only:  # the closed version of a
        expected += [(None, "Z", "R", 1, 1, 7.0, 7.0), (D1, "Z", "R", 2, 1, 3.03, 1.52), (D2, "Z", "R", 1, 1, 5.0, 5.0)]
    assert rows(got) == sorted(expected, key=repr)


def test_not_a_number_reaches_its_group_only(spark, customers):
    data = [fact("t1", "a", float("nan")), fact("t2", "a", 2.0), fact("t3", "b", 3.0)]
    got = {
        r.segment: r
        for r in gold.revenue_by_segment(spark.createDataFrame(data, FACT), customers).collect()
    }
    assert math.isnan(got["X"].total_revenue) and math.isnan(got["X"].avg_transaction_value)
    assert got["Y"].total_revenue == 3.0


def test_amount_beyond_cents_is_summed_as_double(spark, customers):
    data = [fact("t1", "a", 1e300), fact("t2", "a", 2.0)]
    row = gold.revenue_by_segment(spark.createDataFrame(data, FACT), customers).first()
    assert row.total_revenue == 1e300


def test_ltv_keeps_idle_customers(facts, customers):
    got = {r.customer_id: r for r in gold.customer_ltv(facts, customers, AS_OF).collect()}
    assert "orphan" not in got
    assert (got["idle"].lifetime_transactions, got["idle"].lifetime_spend) == (None, None)
    assert got["idle"].customer_tier == "bronze"
    assert got["idle"].tenure_days == 152
    assert got["a"].lifetime_spend == 15.03
    assert got["a"].segment == "X"


def test_staging(facts, customers):
    transactions, current = staged(facts, customers, "2020-02-01")
    assert {r.transaction_id for r in transactions.collect()} == {"t3", "t8"}
    assert dict(transactions.dtypes)["transaction_amount"] == "decimal(28,2)"
    assert current.filter("not is_current").count() == 0
    assert "customer_segment" in current.columns and "segment" not in current.columns


def test_enriched_ratio_is_null_for_zero_and_missing_value(facts, customers):
    got = {
        r.transaction_id: r.txn_to_ltv_ratio
        for r in marts.transactions_enriched(*staged(facts, customers)).collect()
    }
    assert got["t4"] is None and got["t7"] is None
    assert float(got["t1"]) == 0.0101


def test_empty_input_gives_empty_marts(facts, customers):
    inputs = staged(facts.filter("1 = 0"), customers)
    assert marts.daily_revenue(*inputs, unique_transactions=True).count() == 0
    assert marts.customer_360(*inputs).count() == 0


IDS = st.sampled_from([None, "t1", "t2", "t3", "t4"])
BUYERS = st.sampled_from([None, "a", "b", "c"])
CENTS = st.integers(-50_000, 2_000_000).map(lambda n: n / 100)
SOLD = st.lists(st.tuples(IDS, BUYERS, CENTS, st.sampled_from([D1, D2])), min_size=1, max_size=15)
DIMS = st.lists(
    st.tuples(st.sampled_from("abd"), st.sampled_from([None, "X", "Y"]), st.sampled_from([None, "R"])),
    max_size=6,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SOLD, DIMS, st.booleans())
def test_any_input_equals_a_loop_over_sales(spark, data, members, unique):
    if unique:
        data = [(f"u{i}", customer, amount, day) for i, (_, customer, amount, day) in enumerate(data)]
    fact_rows, dim_rows = [fact(*row) for row in data], [dim(*member) for member in members]
    inputs = staged(spark.createDataFrame(fact_rows, FACT), spark.createDataFrame(dim_rows, DIM))
    daily = marts.daily_revenue(*inputs, unique_transactions=unique)
    assert rows(daily) == expected_daily(fact_rows, dim_rows)
    c360 = marts.customer_360(*inputs, as_of=AS_OF, unique_transactions=unique)
    assert rows(c360.select(*SPEND)) == expected_360(fact_rows, dim_rows)
