"""Cohorts from stored bitmaps against distinct counts."""

import datetime as dt
import random
from collections import defaultdict
from itertools import combinations

import pytest

from cohortwise.operators import cohort_cube as CC
from cohortwise.operators import cohorts as CH

DIMS = ["segment", "region"]


def month(n):
    return dt.date(2023 + n // 12, n % 12 + 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows, attrs = [], []
    for c in range(1, 160):
        attrs.append((c, rng.choice(["a", "b", None]), rng.choice(["x", "y", "z"])))
        start = rng.randrange(10)
        rows += [(c, c * 100 + k, month(start + k) + dt.timedelta(days=rng.randrange(28)), 1.0)
                 for k in range(14) if k == 0 or rng.random() < 0.4]
    attrs = [a for a in attrs if a[0] % 17] + attrs[:3]  # some customers are not in the master, some twice
    orders = spark.createDataFrame(rows, "customer_id long, order_id long, order_date date, order_amount double")
    return orders.cache(), spark.createDataFrame(attrs, "customer_id long, segment string, region string").cache()


def brute(orders, attrs, months, sets):
    first, seen, of = {}, defaultdict(set), {r.customer_id: (r.segment, r.region) for r in attrs.collect()}
    for r in orders.collect():
        m = r.order_date.year * 12 + r.order_date.month
        seen[r.customer_id].add(m)
        first[r.customer_id] = min(m, first.get(r.customer_id, m))
    cells = defaultdict(set)
    for c, ms in seen.items():
        d = of.get(c, (None, None))
        for s in sets:
            key = tuple(d[i] if x in s else None for i, x in enumerate(DIMS))
            bits = sum((x not in s) << (len(DIMS) - 1 - i) for i, x in enumerate(DIMS))
            for m in ms:
                cells[bits, first[c], *key, (m - first[c]) // months].add(c)
    return {k: len(v) for k, v in cells.items()}


def rows_of(cube):
    out = {(r.grouping, r.cohort_month.year * 12 + r.cohort_month.month, r.segment, r.region, r.period): r for r in cube.collect()}
    return out


@pytest.mark.parametrize("months,salts", [(1, 1), (3, 1), (5, 4)])
def test_every_grouping_set(spark, data, months, salts):
    orders, attrs = data
    cm = CH.customer_months(orders)
    parts = CC.activity_parts(cm, CC.number_members(cm, attrs, DIMS, salts=salts), DIMS)
    sets = [list(c) for n in range(3) for c in combinations(DIMS, n)]
    got = rows_of(CC.cohort_cube(parts, DIMS, months))
    want = brute(orders, attrs, months, sets)
    assert {k: r.active_customers for k, r in got.items()} == want
    for (g, c, s, r, _), row in got.items():
        assert row.cohort_size == want[g, c, s, r, 0] and row.retention_rate == round(100 * row.active_customers / row.cohort_size, 2)


def test_batches_and_months_delivered_again(spark, data):
    """Parts of later batches are appended; a month that comes in pieces, or twice, changes nothing."""
    orders, attrs = data
    early = orders.where("order_date < '2023-08-15'")
    late = orders.where("order_date >= '2023-08-10'")  # five days twice, August in two pieces
    first = CH.customer_months(early)
    members = CC.number_members(first, attrs, DIMS).cache()
    parts = CC.activity_parts(first, members, DIMS)
    second = CH.customer_months(late)
    more = CC.number_members(second, attrs, DIMS, known=members).cache()
    assert more.join(members, "customer_id").count() == 0 and more.count() > 0
    every = members.unionByName(more)
    assert every.groupBy("cohort_month", *DIMS, "salt", "number").count().where("count > 1").count() == 0
    parts = parts.unionByName(CC.activity_parts(second, every, DIMS))
    got = rows_of(CC.cohort_cube(parts, DIMS))
    assert {k: r.active_customers for k, r in got.items()} == brute(orders, attrs, 1, [list(c) for n in range(3) for c in combinations(DIMS, n)])


def test_chosen_sets_and_nothing(spark, data):
    orders, attrs = data
    cm = CH.customer_months(orders)
    parts = CC.activity_parts(cm, CC.number_members(cm, attrs, DIMS), DIMS)
    got = rows_of(CC.cohort_cube(parts, DIMS, sets=[["region"]]))
    assert {k: r.active_customers for k, r in got.items()} == brute(orders, attrs, 1, [["region"]])
    assert CC.cohort_cube(parts.limit(0), DIMS).count() == 0
