"""Customer runs against brute force over every day, on hand-made orders with
repeated ids, missing ids, missing days and amounts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortwise.config import RiskWeights, StatusThresholds
from cohortwise.operators import facts as FX
from cohortwise.operators import history as HI
from cohortwise.operators import risk as RK
from cohortwise.operators import runs as RU
from cohortwise.operators import status as ST
from cohortwise.sources import tables as T

START, END = dt.date(2024, 1, 1), dt.date(2024, 3, 20)
TH = StatusThresholds(4, 11)
WEIGHTS = RiskWeights(value_drop_enabled=True)


def day(n):
    return START + dt.timedelta(days=n)


DAYS = [day(n) for n in range((END - START).days + 1)]


@pytest.fixture(scope="module")
def orders(spark):
    rng = random.Random(8)
    rows = []
    for c in range(1, 25):
        gap = rng.choice((1, 2, 5, 9, 20))
        at = rng.randrange(30)
        while at < 80:
            # ids come again on later days, some are missing; amounts may be, and are alike for an id and a day
            oid = None if rng.random() < 0.1 else c * 1000 + rng.randrange(12)
            mark = (oid or 0) * 7 + at * 13
            rows.append((c, oid, day(at), None if mark % 11 == 0 else float(1 + mark % 199)))
            at += rng.randrange(0, 2 * gap + 1)
    rows += [(3, 3001, None, 5.0), (40, None, day(3), 9.0), (None, 77, day(5), 1.0), (50, 1, day(70), None)]
    rows += rows[:15]
    return spark.createDataFrame(rows, "customer_id long, order_id long, order_date date, order_amount double").cache()


@pytest.fixture(scope="module")
def brute(spark, orders):
    """Risk rows of every customer on every day, one as-of replay a day."""
    out = {}
    customers = spark.createDataFrame([], "customer_id long, customer_email string, country string, customer_segment string, "
                                          "acquisition_channel string, signup_date date")
    days = spark.createDataFrame([(d,) for d in DAYS], "snapshot_date date")
    # all days at once: each order under the days from its own on
    spread = orders.join(days, orders["order_date"] <= days["snapshot_date"]).withColumn(
        "customer_id", F.struct("customer_id", "snapshot_date"))
    facts = FX.base_customers(spread, customers.withColumn("customer_id", F.struct("customer_id", F.lit(None).cast("date").alias("snapshot_date"))),
                              with_last_order_value=True)
    flat = facts.withColumn("snapshot_date", F.col("customer_id.snapshot_date")).withColumn("customer_id", F.col("customer_id.customer_id"))
    risk = RK.churn_detection(flat, F.col("snapshot_date"), TH, WEIGHTS, keep=["snapshot_date"])
    for r in risk.collect():
        out[r.customer_id, r.snapshot_date] = r
    return out


@pytest.fixture(scope="module")
def runs(orders):
    return RU.risk_runs(RU.order_day_facts(orders), TH, WEIGHTS).cache()


def test_runs_equal_every_day(runs, brute):
    seen = {}
    for r in runs.collect():
        for d in DAYS:
            if r.from_day <= d and (r.to_day is None or d < r.to_day):
                assert (r.customer_id, d) not in seen
                seen[r.customer_id, d] = r
    assert set(seen) == set(brute) and len(brute) > 800
    columns = [c for c in RK.RISK_COLUMNS if c != "days_since_last_order"]
    for key, want in brute.items():
        got = seen[key]
        for c in columns:
            a, b = got[c], want[c]
            assert a == b or (isinstance(a, float) and abs(a - b) < 1e-9), (key, c, a, b)
    levels = Counter(r.churn_risk_level for r in brute.values())
    assert len(levels) == 3 and any(r.is_value_drop for r in brute.values()) and any(r.is_frequency_drop for r in brute.values())


def test_runs_are_few(runs, brute):
    per_customer_day = len(brute)
    assert runs.count() < per_customer_day / 2


def test_risk_history(runs, brute):
    want = Counter((d, r.retention_status, r.churn_risk_level) for (_, d), r in brute.items() if d >= day(10))
    got = RU.risk_history(runs, day(10), END, by=["retention_status"]).collect()
    assert {(r.snapshot_date, r.retention_status, r.churn_risk_level): r.customer_count for r in got} == dict(want)
    for r in got:
        assert r.total_customers == sum(n for (d, s, _), n in want.items() if (d, s) == (r.snapshot_date, r.retention_status))


@pytest.mark.parametrize("col", ["retention_status", "churn_risk_level", "churn_risk_score"])
def test_flow_matrix(runs, brute, col):
    want = Counter()
    for (c, d), r in brute.items():
        if d >= day(1):
            before = brute.get((c, d - dt.timedelta(days=1)))
            want[d, str(before[col]) if before else RU.NOT_A_CUSTOMER, str(r[col])] += 1
    src = runs.withColumn(col, F.col(col).cast("string"))
    got = {(r[0], r[1], r[2]): r[3] for r in RU.flow_matrix(src, day(1), END, col).collect()}
    assert got == dict(want)


def test_level_changes(runs, brute):
    want = set()
    for (c, d), r in brute.items():
        before = brute.get((c, d - dt.timedelta(days=1)))
        if d >= day(1) and (before is None or before.churn_risk_score != r.churn_risk_score):
            want.add((c, d, before.churn_risk_score if before else None, r.churn_risk_score))
    got = RU.level_changes(runs, day(1), END).collect()
    assert {(r.customer_id, r.change_date, r.previous_score, r.churn_risk_score) for r in got} == want and len(got) == len(want)
    assert all(r.score_change == r.churn_risk_score - (r.previous_score or 0) for r in got)


def test_status_runs_share_every_source(spark, orders):
    """Order-day intervals and day facts give the same status runs; customers without an id have them too."""
    a = RU.status_runs(HI.order_day_intervals(orders), TH)
    b = RU.status_runs(RU.order_day_facts(orders), TH)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where("customer_id IS NULL").count() > 0


def test_run_table(spark, orders, tmp_dir):
    """Snapshots read off the interval table equal daily ones; expiring runs leaves the days kept."""
    path = f"{tmp_dir}/runs"
    runs = RU.status_runs(HI.order_day_intervals(orders), TH)
    T.write_snapshot_runs(runs, path)
    days = [day(9), day(45), END]
    daily = [r for d in days for r in ST.retention_status(FX.order_aggregates(orders, d).where(
        "total_orders >= 1 AND first_order_date IS NOT NULL"), d, TH).collect()]
    got = T.read_snapshot_days(spark, path, days).collect()
    assert sorted(map(str, got)) == sorted(map(str, daily))
    customers_x_days = HI.status_history(orders, START, END, TH).agg(F.sum("customer_count")).first()[0]
    stored = spark.read.parquet(path)
    assert stored.count() < customers_x_days / 2
    assert T.expire_runs(spark, path, END, 15) == ["2024-01-01", "2024-02-01"]
    after = T.read_snapshot_days(spark, path, [day(65), END]).collect()
    assert sorted(map(str, after)) == sorted(map(str, [r for d in (day(65), END) for r in T.read_snapshot_days(spark, path, [d]).collect()]))
    assert sorted(str(r) for r in after if r.snapshot_date == END) == sorted(str(r) for r in got if r.snapshot_date == END)
    assert spark.read.parquet(path).count() < customers_x_days / 4


def test_one_scan_of_orders(runs, orders, spark, tmp_dir):
    orders.write.parquet(f"{tmp_dir}/orders")
    stored = spark.read.parquet(f"{tmp_dir}/orders")
    df = RU.risk_history(RU.risk_runs(RU.order_day_facts(stored), TH), START, END)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    flows = RU.flow_matrix(RU.status_runs(HI.order_day_intervals(stored), TH), START, END)
    assert flows._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_empty(spark, orders):
    runs = RU.risk_runs(RU.order_day_facts(orders.limit(0)), TH)
    assert RU.risk_history(runs, START, END).count() == 0 and RU.flow_matrix(runs, START, END).count() == 0
