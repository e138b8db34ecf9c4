"""Equivalences: A/B cross join = separate runs; literal = as-of once the
reference date is past every order; delta history = brute force on random
order sets."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortwise.config import PROFILES, StatusThresholds
from cohortwise.operators import facts as FX
from cohortwise.operators import status as ST
from cohortwise.sources import testdata as src
from test_history import brute_force, delta

SF = "/root/testdata/sf0.001"


def test_ab_sets_equal_separate_runs(spark):
    f = FX.base_customers(src.orders(spark, SF), src.customers(spark, SF))
    sets = list(PROFILES.values())
    got = {(r.threshold_set, r.retention_status): r.customer_count
           for r in ST.threshold_set_distribution(f, "2001-07-31", ST.threshold_sets_df(spark, sets)).collect()}
    want = {}
    for s in sets:
        for r in ST.retention_status(f, "2001-07-31", s).groupBy("retention_status").count().collect():
            want[(s.name, r[0])] = r[1]
    assert got == want


def test_literal_equals_asof_after_last_order(spark):
    o, c = src.orders(spark, SF), src.customers(spark, SF)
    ref = "2001-08-01"  # the day of the last order
    lit = sorted(map(tuple, ST.retention_status(FX.base_customers(o, c), ref).collect()))
    asof = sorted(map(tuple, ST.retention_status(FX.base_customers(o, c, as_of=ref), ref).collect()))
    assert lit == asof


orders_strategy = st.lists(
    st.tuples(st.sampled_from([1, 2, 3, None]), st.one_of(st.none(), st.integers(1, 30)), st.integers(0, 59)),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=orders_strategy, a=st.integers(0, 10), extra=st.integers(0, 20))
def test_random_history_matches_brute_force(spark, rows, a, extra):
    d0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [(c, o, d0 + dt.timedelta(days=k), 1.0) for c, o, k in rows],
        "customer_id long, order_id long, order_date date, order_amount double")
    th = StatusThresholds(a, a + extra)
    assert delta(df, "2024-01-05", "2024-03-15", th) == brute_force(df, "2024-01-05", "2024-03-15", th)
