"""Delta-form daily history against brute force (customers x days)."""

import datetime as dt

from pyspark.sql import functions as F

from cohortwise.config import StatusThresholds
from cohortwise.operators import facts as FX
from cohortwise.operators import history as HI
from cohortwise.operators import status as ST
from cohortwise.sources import testdata as src

D = dt.date.fromisoformat
SF = "/root/testdata/sf0.001"


def brute_force(orders, start, end, th):
    """As-of facts for every day: orders <= day, grouped per (day, customer)."""
    cal = HI.calendar(orders.sparkSession, start, end)
    j = cal.join(orders, orders["order_date"] <= cal["snapshot_date"])
    g = j.groupBy("snapshot_date", "customer_id").agg(
        F.max("order_date").alias("last_order_date"), F.count_distinct("order_id").alias("n"))
    g = g.where(F.col("n") >= 1)
    d = F.datediff("snapshot_date", "last_order_date")
    s = g.select("snapshot_date", ST.status_expr(d, th.active_days, th.at_risk_days).alias("retention_status"))
    return {(r[0], r[1]): r[2] for r in s.groupBy("snapshot_date", "retention_status").count().collect()}


def delta(orders, start, end, th):
    h = HI.status_history(orders, start, end, th)
    return {(r.snapshot_date, r.retention_status): r.customer_count for r in h.collect()}


def test_history_matches_brute_force_on_fixture(spark):
    rows = [
        (1, 1, "2024-01-01"), (1, 2, "2024-01-01"), (1, 3, "2024-01-20"),  # same-day duplicates
        (2, None, "2024-01-03"), (2, 4, "2024-01-10"),                       # entry after first order day
        (None, 5, "2024-01-05"), (None, 6, "2024-03-01"),                    # NULL customer is one customer
        (3, 7, "2023-12-01"),                                                # before the window
        (4, None, "2024-01-02"),                                             # never a customer (no order id)
        (5, 8, None),                                                        # undated order
        (6, 9, "2024-02-15"), (6, 9, "2024-02-16"),                          # one order id on two days
    ]
    orders = spark.createDataFrame(
        [(c, o, D(d) if d else None, 1.0) for c, o, d in rows],
        "customer_id long, order_id long, order_date date, order_amount double")
    for th in (StatusThresholds(), StatusThresholds(2, 5), StatusThresholds(0, 0)):
        assert delta(orders, "2024-01-01", "2024-04-30", th) == brute_force(orders, "2024-01-01", "2024-04-30", th)


def test_history_matches_brute_force_on_testdata(spark):
    o = src.orders(spark, SF)
    th = StatusThresholds()
    assert delta(o, "2000-06-01", "2001-07-31", th) == brute_force(o, "2000-06-01", "2001-07-31", th)


def test_history_equals_asof_snapshot_counts(spark):
    """FIXTURES.md: as-of counts at 2000-12-31 on sf0.001 are 21 / 24 / 105."""
    h = HI.status_history(src.orders(spark, SF), "2000-12-31", "2000-12-31")
    got = {r.retention_status: r.customer_count for r in h.collect()}
    assert got == {"ACTIVE": 21, "AT_RISK": 24, "INACTIVE": 105}


def test_literal_and_asof_status_counts(spark):
    o, c = src.orders(spark, SF), src.customers(spark, SF)

    def counts(df):
        return {r[0]: r[1] for r in df.groupBy("retention_status").count().collect()}

    assert counts(ST.retention_status(FX.base_customers(o, c), "2001-07-31")) == {
        "ACTIVE": 29, "AT_RISK": 23, "INACTIVE": 97, "DATA_QUALITY_ISSUE": 1}
    assert counts(ST.retention_status(FX.base_customers(o, c), "2000-12-31")) == {
        "ACTIVE": 10, "AT_RISK": 11, "INACTIVE": 44, "DATA_QUALITY_ISSUE": 85}
    assert counts(ST.retention_status(FX.base_customers(o, c, as_of="2000-12-31"), "2000-12-31")) == {
        "ACTIVE": 21, "AT_RISK": 24, "INACTIVE": 105}


def test_dense_history_zero_fills(spark):
    orders = spark.createDataFrame([(1, 1, D("2024-01-01"), 1.0)],
                                   "customer_id long, order_id long, order_date date, order_amount double")
    sparse = HI.status_history(orders, "2024-01-01", "2024-01-10")
    dense = HI.status_history(orders, "2024-01-01", "2024-01-10", dense=True)
    assert sparse.count() == 10 and dense.count() == 30
    assert dense.where(F.col("retention_status") == "AT_RISK").agg(F.max("customer_count")).first()[0] == 0


def test_scoped_dense_history_matches_brute_force(spark):
    rows = [(1, 1, "2024-01-01"), (2, 2, "2024-01-03"), (2, None, "2024-01-02"), (3, 3, "2024-02-01"),
            (4, 4, "2024-06-01"), (None, 5, "2024-01-04")]
    orders = spark.createDataFrame([(c, o, D(d), 1.0) for c, o, d in rows],
                                   "customer_id long, order_id long, order_date date, order_amount double")
    attrs = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "C")], "customer_id long, seg string")
    th = StatusThresholds(5, 20)
    h = HI.status_history(orders, "2024-01-01", "2024-03-31", th, dense=True, attributes=attrs, by=["seg"])
    got = {(r.seg, r.snapshot_date, r.retention_status): r.customer_count for r in h.collect()}
    # brute force: as-of status per (segment, day), zero-filled over the segments seen in the window
    cal = HI.calendar(spark, "2024-01-01", "2024-03-31")
    j = cal.join(orders, orders["order_date"] <= cal["snapshot_date"])
    g = j.groupBy("snapshot_date", "customer_id").agg(
        F.max("order_date").alias("last"), F.count_distinct("order_id").alias("n")).where("n >= 1")
    g = g.join(attrs, "customer_id", "left")
    st = ST.status_expr(F.datediff("snapshot_date", "last"), th.active_days, th.at_risk_days)
    cnt = {(r[0], r[1], r[2]): r[3] for r in g.groupBy("seg", "snapshot_date", st.alias("s")).count().collect()}
    segs = {k[0] for k in cnt}
    days = [r[0] for r in cal.collect()]
    want = {(sg, d, s): cnt.get((sg, d, s), 0) for sg in segs for d in days for s in ("ACTIVE", "AT_RISK", "INACTIVE")}
    assert "C" not in segs and got == want
