"""Hand-written fixtures MF1 (status, risk), MF2 (cohorts), MF3 (alerts)."""

import datetime as dt

from pyspark.sql import functions as F

from cohortwise.config import AlertConfig, RiskWeights, StatusThresholds
from cohortwise.operators import alerts as AL
from cohortwise.operators import cohorts as CH
from cohortwise.operators import facts as FX
from cohortwise.operators import risk as RK
from cohortwise.operators import status as ST

D = dt.date.fromisoformat
ORDER_SCHEMA = "customer_id long, order_id long, order_date date, order_amount double, order_status string"
CUST_SCHEMA = ("customer_id long, customer_email string, country string, customer_segment string, "
               "acquisition_channel string, signup_date date")

MF1 = {
    1: ["2026-01-02"],
    2: ["2025-12-03"],
    3: ["2025-12-02"],
    4: ["2025-10-04"],
    5: ["2025-10-03"],
    6: ["2026-01-03"],
    7: ["2025-11-08", "2025-11-18", "2025-11-28", "2025-12-08"],
    8: ["2025-08-20", "2025-09-19", "2025-10-19", "2025-11-18"],
    9: ["2025-08-19", "2025-09-18", "2025-10-18", "2025-11-17"],
    10: ["2026-01-01", "2026-01-01"],
    11: ["2025-08-14", "2025-09-13", "2025-10-13", "2025-11-12", "2025-12-12"],
    13: ["2025-12-20"],
    14: ["2025-08-05", "2025-09-01", "2025-10-01", "2025-11-13"],
    None: ["2025-12-20"],
}
# id: (days, status, freq, inconsistent, score, level)
MF1_EXPECTED = {
    1: (0, "ACTIVE", False, True, 20, "LOW"),
    2: (30, "ACTIVE", False, True, 20, "LOW"),
    3: (31, "AT_RISK", False, False, 0, "LOW"),
    4: (90, "AT_RISK", False, False, 0, "LOW"),
    5: (91, "INACTIVE", False, False, 0, "LOW"),
    6: (-1, "DATA_QUALITY_ISSUE", False, False, 0, "LOW"),
    7: (25, "ACTIVE", True, True, 70, "HIGH"),
    8: (45, "AT_RISK", False, False, 0, "LOW"),
    9: (46, "AT_RISK", True, False, 50, "MEDIUM"),
    10: (1, "ACTIVE", True, True, 70, "HIGH"),
    11: (21, "ACTIVE", False, False, 0, "LOW"),
    13: (13, "ACTIVE", False, True, 20, "LOW"),
    14: (50, "AT_RISK", False, False, 0, "LOW"),
}
REF = "2026-01-02"


def _orders(spark, spec):
    rows, oid = [], 0
    for cid, dates in spec.items():
        for d in dates:
            oid += 1
            rows.append((cid, oid, D(d), 100.0 + oid, "completed"))
    return spark.createDataFrame(rows, ORDER_SCHEMA)


def _customers(spark, ids):
    return spark.createDataFrame([(i, None, "BE", "B2C", None, None) for i in ids], CUST_SCHEMA)


def test_mf1_status_and_risk(spark):
    orders = _orders(spark, MF1)
    facts = FX.base_customers(orders, _customers(spark, [i for i in range(1, 13) if i != 13]))
    ids = {r["customer_id"] for r in facts.collect()}
    assert 12 not in ids and 13 in ids and None in ids  # inner side of facts, left join, NULL key
    status = {r["customer_id"]: r for r in ST.retention_status(facts, REF).collect()}
    assert status[None]["retention_status"] == "ACTIVE"
    risk = {r["customer_id"]: r for r in RK.churn_detection(facts, REF).collect()}
    assert None not in risk
    for cid, (days, st, fq, inc, score, level) in MF1_EXPECTED.items():
        r = risk[cid]
        assert (r.days_since_last_order, r.retention_status, r.is_frequency_drop, r.is_status_inconsistent,
                r.churn_risk_score, r.churn_risk_level) == (days, st, fq, inc, score, level), cid
        assert status[cid]["retention_status"] == st
    f13 = facts.where(F.col("customer_id") == 13).first()
    assert f13.country is None and f13.customer_segment is None


def test_wide_profile_exact_multiplier(spark):
    # gap 90, 63 days of silence: 0.7 * 90 = 62.99999999999999 in doubles
    spec = {1: ["2025-01-03", "2025-04-03", "2025-07-02", "2025-09-30"]}
    ref = (D("2025-09-30") + dt.timedelta(days=63)).isoformat()
    facts = FX.base_customers(_orders(spark, spec), _customers(spark, [1]))
    r = RK.churn_detection(facts, ref, StatusThresholds(365, 730)).first()
    assert r.days_since_last_order == 63 and r.is_status_inconsistent is False and r.churn_risk_score == 0


def test_reachable_scores(spark):
    """D3: with the value signal off, ACTIVE in {0,20,70}, others in {0,50}, DQ 0."""
    from cohortwise.sources import testdata as src

    sf = "/root/testdata/sf0.001"
    f = FX.base_customers(src.orders(spark, sf), src.customers(spark, sf))
    for th in (StatusThresholds(), StatusThresholds(365, 730)):
        rows = RK.churn_detection(f, "2001-07-31", th).groupBy("retention_status", "churn_risk_score").count().collect()
        for r in rows:
            allowed = {"ACTIVE": {0, 20, 70}, "DATA_QUALITY_ISSUE": {0}}.get(r[0], {0, 50})
            assert r[1] in allowed, r


def test_value_drop_signal(spark):
    spec = {1: ["2025-10-01", "2025-11-01", "2025-12-01"]}
    rows = [(1, 1, D("2025-10-01"), 100.0, None), (1, 2, D("2025-11-01"), 100.0, None),
            (1, 3, D("2025-12-01"), 10.0, None)]
    orders = spark.createDataFrame(rows, ORDER_SCHEMA)
    facts = FX.base_customers(orders, _customers(spark, [1]), with_last_order_value=True)
    assert facts.first().last_order_value == 10.0
    r = RK.churn_detection(facts, "2025-12-10", weights=RiskWeights(value_drop_enabled=True)).first()
    assert r.is_value_drop is True and r.churn_risk_score == 50  # 30 + 20 (ACTIVE, n <= 3)
    r0 = RK.churn_detection(facts, "2025-12-10").first()
    assert r0.is_value_drop is False and r0.churn_risk_score == 20
    assert len(spec) == 1


def test_mf2_cohorts(spark):
    spec = {1: ["2024-01-31", "2024-02-01", "2024-04-10"], 2: ["2024-01-05", "2024-02-20"],
            3: ["2024-02-10", "2024-02-11"]}
    got = {(r.cohort_month.isoformat(), r.months_since_acquisition): (r.cohort_size, r.active_customers, r.retention_rate)
           for r in CH.cohort_retention(_orders(spark, spec)).collect()}
    assert got == {
        ("2024-01-01", 0): (2, 2, 100.0),
        ("2024-01-01", 1): (2, 2, 100.0),
        ("2024-01-01", 3): (2, 1, 50.0),
        ("2024-02-01", 0): (1, 1, 100.0),
    }


def _dist(spark, values, totals=None, start="2024-03-01", status="AT_RISK"):
    d0 = D(start)
    totals = totals or [1000] * len(values)
    rows = [(d0 + dt.timedelta(days=i), status, int(round(v * t / 100)), t, float(v))
            for i, (v, t) in enumerate(zip(values, totals))]
    return spark.createDataFrame(
        rows, "snapshot_date date, retention_status string, customer_count long, total_customers long, status_pct double")


def _last(spark, values, totals=None, cfg=AlertConfig()):
    rows = AL.alert_logic(_dist(spark, values, totals), cfg).orderBy("alert_date").collect()
    return rows[-1]


def test_mf3_alerts(spark):
    base = [20.0] * 7
    cases = [
        (22.99, 1000, 14.95, "INFO", False),
        (23.0, 1000, 15.0, "WARNING", True),
        (24.99, 1000, 24.95, "WARNING", True),
        (25.0, 1000, 25.0, "CRITICAL", True),
        (17.0, 1000, -15.0, "INFO", False),
        (25.0, 99, 25.0, "CRITICAL", False),
    ]
    for cur, n, rel, sev, flag in cases:
        r = _last(spark, base + [cur], [1000] * 7 + [n])
        assert (r.delta_relative_pct, r.severity, r.alert_flag) == (rel, sev, flag), cur
        assert r.baseline_value == 20.0 and r.sample_size == n
    warm = _last(spark, [25.0])
    assert warm.baseline_value is None and warm.severity == "INFO" and warm.alert_flag is False
    zero = _last(spark, [0.0] * 7 + [25.0])
    assert zero.delta_relative_pct is None and zero.severity == "INFO" and zero.alert_flag is False


def test_alert_variants(spark):
    # 28-row baseline, 7-row warm-up, consecutive days, same day last week, median
    vals = [20.0] * 10 + [25.0, 25.0]
    rows = AL.alert_logic(_dist(spark, vals), AlertConfig(consecutive_days=2)).orderBy("alert_date").collect()
    assert [r.alert_flag for r in rows[-2:]] == [False, True]
    warm = AL.alert_logic(_dist(spark, [20.0] * 3 + [25.0]), AlertConfig(min_history=7)).orderBy("alert_date").collect()
    assert warm[-1].baseline_value is None
    med = AL.alert_logic(_dist(spark, [10.0, 10.0, 40.0, 25.0]), AlertConfig(baseline="median")).orderBy(
        "alert_date").collect()
    assert med[-1].baseline_value == 10.0
    wk = AL.alert_logic(_dist(spark, [20.0] * 7 + [30.0]), AlertConfig(baseline="same_day_last_week")).orderBy(
        "alert_date").collect()
    assert wk[-1].baseline_value == 20.0 and wk[-2].baseline_value is None


def test_calendar_hole_rows_vs_range(spark):
    """ROWS counts rows, RANGE counts calendar days."""
    rows = [(D("2024-01-01"), 10.0), (D("2024-01-02"), 20.0), (D("2024-01-20"), 30.0)]
    dist = spark.createDataFrame(
        [(d, "AT_RISK", 1, 1000, v) for d, v in rows],
        "snapshot_date date, retention_status string, customer_count long, total_customers long, status_pct double")
    by_rows = AL.alert_logic(dist).orderBy("alert_date").collect()
    by_range = AL.alert_logic(dist, AlertConfig(baseline="range")).orderBy("alert_date").collect()
    assert by_rows[-1].baseline_value == 15.0
    assert by_range[-1].baseline_value is None


def test_single_day_alert_is_inert(spark):
    facts = FX.base_customers(_orders(spark, MF1), _customers(spark, range(1, 15)))
    r = AL.single_day_alert(ST.retention_status(facts, REF), REF).collect()
    assert len(r) == 1 and r[0].baseline_value is None and r[0].alert_flag is False


def test_suppression_and_routing(spark):
    dist = _dist(spark, [20.0] * 7 + [25.0, 25.0], start="2024-03-01")
    alerts = AL.alert_logic(dist)
    cal = spark.createDataFrame([(D("2024-03-09"), D("2024-03-10"))], "start_date date, end_date date")
    sup = {r.alert_date.isoformat(): (r.alert_flag, r.suppressed) for r in AL.suppress_campaigns(alerts, cal).collect()}
    assert sup["2024-03-08"] == (True, False) and sup["2024-03-09"] == (False, True)
    routed = AL.route_alerts(alerts).collect()
    # day 8 is CRITICAL (two destinations); day 9 (baseline now 20.71) is WARNING
    assert sorted(r.destination for r in routed) == ["email", "executive-alerts", "retention-monitoring"]


def test_literal_table_is_known_to_be_small(spark):
    from cohortwise.functions.literals import literal_table

    t = literal_table(spark, [("a", 1.5, None), ("b", 2.5, "2024-01-31")], "k string, x double, d date")
    assert [tuple(r) for r in t.collect()] == [("a", 1.5, None), ("b", 2.5, D("2024-01-31"))]
    big = spark.range(0, 200_001).select(F.col("id").cast("string").alias("k"))
    assert "Broadcast" in big.join(t, "k")._jdf.queryExecution().executedPlan().toString()


def test_worked_examples_v3_v4_v6_v7(spark):
    from cohortwise.operators import quality as QC

    ref = D("2026-01-02")

    def days_ago(*ks):
        return [(ref - dt.timedelta(days=k)).isoformat() for k in ks]

    spec = {
        31: days_ago(65, 45, 25),            # V3: gap 20, day 25 -> LOW (20)
        32: days_ago(57, 41, 25),            # V3: gap 16 < 16.67 -> HIGH (70)
        41: days_ago(145, 115, 85, 55, 25),  # V4: monthly buyer at day 25 -> 20, LOW
        42: days_ago(1155, 790, 425, 60),    # V4: yearly buyer at day 60 -> 0, LOW
    }
    facts = FX.base_customers(_orders(spark, spec), _customers(spark, spec))
    got = {r.customer_id: (r.churn_risk_score, r.churn_risk_level) for r in RK.churn_detection(facts, REF).collect()}
    assert got == {31: (20, "LOW"), 32: (70, "HIGH"), 41: (20, "LOW"), 42: (0, "LOW")}

    # V6: 25.3 vs a 20.1 baseline, n = 1,847 -> +5.2 pp, +25.87 %, CRITICAL, flagged
    r = _last(spark, [20.1] * 7 + [25.3], [1847] * 8)
    assert (round(r.delta_pct, 6), r.delta_relative_pct, r.severity, r.alert_flag) == (5.2, 25.87, "CRITICAL", True)

    # V7: 1,245 / 982 / 2,140 customers -> 28.5 / 22.5 / 49.0 %
    snap = spark.createDataFrame(
        [("ACTIVE",)] * 1245 + [("AT_RISK",)] * 982 + [("INACTIVE",)] * 2140, "retention_status string")
    pct = {r.retention_status: r.pct for r in QC.status_distribution(snap).collect()}
    assert pct == {"ACTIVE": 28.5, "AT_RISK": 22.5, "INACTIVE": 49.0}
