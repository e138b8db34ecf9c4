"""Queries over written tables, and checks on data that violates them.

The table queries write a layer to a fresh folder of the cluster's checkpoint
folder, as the daily job does, write part of it again, read it back and return
the rows. The violation queries derive faulty input from the given tables
(rows twice, refunds, two statuses a day, ...) so that a check has to find it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortwise import config as C
from cohortwise.functions.literals import literal_table
from cohortwise.functions.numeric import money
from cohortwise.operators import alerts as AL
from cohortwise.operators import campaigns as CP
from cohortwise.operators import cohorts as CH
from cohortwise.operators import facts as FX
from cohortwise.operators import history as HI
from cohortwise.operators import quality as QC
from cohortwise.operators import risk as RK
from cohortwise.operators import status as ST
from cohortwise.plans import catalog as K
from cohortwise.plans import oracle as O
from cohortwise.session import checkpoint_dir
from cohortwise.sources import tables as T
from cohortwise.sources import testdata as src

register = K.register
_BASE = [O.ord_cte(), O.cust_cte(), O.facts_cte()]


def _path(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------
# Layer tables written and read back
# --------------------------------------------------------------------------
@register("table_facts", O.with_(O.ord_cte(as_of=K.PAST), O.cust_cte(), O.facts_cte()) + f"SELECT {K._FACT_SEL} FROM buyer")
def q_table_facts(spark, sf):
    """SNK1: facts of a late day, then of an earlier one in their place."""
    path = _path(spark, "facts")
    for day in (K.REF, K.PAST):
        T.write_facts(K._facts(spark, sf, as_of=day), path)
    return K._money_facts(T.read_facts(spark, path))


@register("table_snapshots", O.with_(*_BASE, O.status_cte(K.PAST, name="d1"), O.status_cte(K.REF, K.WIDE, name="d2"))
          + "SELECT * FROM d1 UNION ALL SELECT * FROM d2")
def q_table_snapshots(spark, sf):
    """SNK2 / SRC4: two days, the second written again under other thresholds."""
    path, f = _path(spark, "snapshots"), K._facts(spark, sf)
    for day, th in ((K.PAST, C.StatusThresholds()), (K.REF, C.StatusThresholds()), (K.REF, K.WIDE)):
        T.write_snapshot(ST.retention_status(f, day, th), path)
    return T.read_snapshot(spark, path, K.PAST, K.REF).select(*ST.STATUS_COLUMNS)


@register("table_risk_from_snapshot", K._risk_sql(K.REF, K.WIDE))
def q_table_risk_from_snapshot(spark, sf):
    """SRC4 / J2: risk from the stored snapshot of the day, of a table with two."""
    path, f = _path(spark, "snapshots"), K._facts(spark, sf)
    T.write_snapshot(ST.retention_status(f, K.PAST, K.WIDE), path)
    T.write_snapshot(ST.retention_status(f, K.REF, K.WIDE), path)
    return K._money_facts(RK.churn_detection(f, K.REF, snapshot=T.read_snapshot(spark, path, K.REF, K.REF)))


@register("table_cohorts", O.with_(O.ord_cte(statuses=["F"]), O.cust_cte(), O.facts_cte(), O.cohort_ctes())
          + "SELECT * FROM cohort_cells")
def q_table_cohorts(spark, sf):
    """SNK3: cohorts of all orders, then of valid orders in their place."""
    path = _path(spark, "cohorts")
    T.write_cohorts(CH.cohort_retention(src.orders(spark, sf)), path)
    T.write_cohorts(CH.cohort_retention(src.orders(spark, sf, accepted_statuses=["F"])), path)
    return spark.read.parquet(path).select(*CH.COHORT_COLUMNS)


@register("table_outbox", O.with_(*K._hist_sql(True), O.alert_ctes()) + K._ROUTES_SQL)
def q_table_outbox(spark, sf):
    """SNK4: the same alerts delivered twice are in the outbox once."""
    path = _path(spark, "outbox")
    routed = AL.route_alerts(K._alert(spark, sf))
    for _ in range(2):
        T.write_outbox(routed, path, fmt="parquet")
    return spark.read.parquet(path).select(*routed.columns)


# --------------------------------------------------------------------------
# Cohorts from facts; a layer 4 that disagrees with layer 1
# --------------------------------------------------------------------------
_FACTS_ALL_ORDERS_F = [O.ord_cte("ord_all"), O.ord_cte("ord", statuses=["F"]), O.cust_cte(), O.facts_cte(ord_name="ord_all")]


@register("cohort_from_facts", O.with_(*_BASE, O.cohort_ctes(by="customer_segment")) + "SELECT * FROM cohort_cells")
def q_cohort_from_facts(spark, sf):
    return CH.cohort_retention(src.orders(spark, sf), by=["customer_segment"], facts=K._facts(spark, sf))


@register("qc_m0_below_95_filtered", O.with_(*_FACTS_ALL_ORDERS_F, O.cohort_ctes()) + """SELECT cohort_month,
  months_since_acquisition, retention_rate FROM cohort_cells WHERE months_since_acquisition = 0 AND retention_rate < 95""")
def q_qc_m0_below_95_filtered(spark, sf):
    """Q14 on facts of all orders and the activity of valid orders only."""
    valid = src.orders(spark, sf, accepted_statuses=["F"])
    return QC.m0_below(CH.cohort_retention(valid, facts=K._facts(spark, sf)))


@register("qc_cohort_size_mixed", O.with_(*_BASE, O.cohort_ctes(), O.ord_cte("ord_f", statuses=["F"]),
          O.facts_cte("buyer_f", "ord_f"), O.cohort_ctes(facts="buyer_f", ord_name="ord_f", name="cells_f")
          .replace("members", "members_f").replace("seen_months", "seen_f").replace("counted_cells", "counted_f")
          .replace("cells AS (\n  SELECT DISTINCT", "some_f AS (\n  SELECT DISTINCT").replace("FROM cells c", "FROM some_f c"))
          + """SELECT cohort_month, cohort_size, COUNT(DISTINCT months_since_acquisition) AS maturity_months_tracked
FROM (SELECT * FROM cohort_cells UNION ALL SELECT * FROM cells_f) GROUP BY cohort_month, cohort_size""")
def q_qc_cohort_size_mixed(spark, sf):
    """Q12 on a table that mixes cohorts of all and of valid orders."""
    both = CH.cohort_retention(src.orders(spark, sf)).unionByName(
        CH.cohort_retention(src.orders(spark, sf, accepted_statuses=["F"])))
    return QC.cohort_size_consistency(both)


# --------------------------------------------------------------------------
# Checks that find something
# --------------------------------------------------------------------------
@register("qc_duplicate_customers_found", O.with_(*_BASE) + """SELECT customer_id, CAST(2 AS BIGINT) AS row_count
FROM buyer WHERE customer_segment = 'MACHINERY'""")
def q_qc_duplicate_customers_found(spark, sf):
    f = K._facts(spark, sf)
    return QC.duplicate_customers(f.unionByName(f.where("customer_segment = 'MACHINERY'")))


@register("qc_negative_facts_found", O.with_(O.ord_cte("plain"), """ord AS (SELECT customer_id, order_id, order_date,
  order_amount * IF(order_status = 'F', -1, 1) AS order_amount, order_status FROM plain)""", O.cust_cte(), O.facts_cte())
          + f"SELECT {K._FACT_SEL} FROM buyer WHERE total_revenue < 0")
def q_qc_negative_facts_found(spark, sf):
    """Q3 with the orders of one status booked as refunds."""
    refunds = src.orders(spark, sf).withColumn(
        "order_amount", F.when(F.col("order_status") == "F", -F.col("order_amount")).otherwise(F.col("order_amount")))
    return K._money_facts(QC.negative_facts(FX.base_customers(refunds, src.customers(spark, sf))))


@register("qc_multi_status_found", O.with_(*_BASE, O.status_cte(K.REF, name="d1"), O.status_cte(K.REF, K.WIDE, name="d2"))
          + """SELECT d1.customer_id, d1.snapshot_date, CAST(2 AS BIGINT) AS status_count FROM d1 JOIN d2 USING (customer_id)
WHERE d1.retention_status <> d2.retention_status""")
def q_qc_multi_status_found(spark, sf):
    f = K._facts(spark, sf)
    both = ST.retention_status(f, K.REF).unionByName(ST.retention_status(f, K.REF, K.WIDE))
    return QC.multi_status_customers(both).where("customer_id IS NOT NULL")


HEAVY = C.RiskWeights(frequency_drop=90, status_inconsistent=40)


@register("qc_score_range_found", O.with_(*_BASE, O.status_cte(K.REF, K.WIDE), O.risk_cte(HEAVY))
          + f"SELECT {K._RISK_SEL} FROM risk WHERE churn_risk_score > 100")
def q_qc_score_range_found(spark, sf):
    return K._money_facts(QC.score_out_of_range(RK.churn_detection(K._facts(spark, sf), K.REF, K.WIDE, HEAVY)))


@register("qc_rate_range_found", O.with_(*_BASE, O.cohort_ctes()) + """SELECT cohort_month, months_since_acquisition,
  retention_rate * 1.5 AS retention_rate, active_customers, cohort_size FROM cohort_cells WHERE retention_rate * 1.5 > 100""")
def q_qc_rate_range_found(spark, sf):
    """Q13 on rates scaled by half as much again."""
    return QC.rate_out_of_range(K._coh(spark, sf).withColumn("retention_rate", F.col("retention_rate") * 1.5))


@register("qc_missing_baseline_found", K._alert_sql(K.BWEEK, dense=False).replace("SELECT * FROM alerts", f"""SELECT alert_date,
  baseline_value, current_value, ABS(current_value - baseline_value) AS deviation FROM alerts
WHERE baseline_value IS NULL AND alert_date > {O.d(K.H_START)} + INTERVAL 7 DAY"""))
def q_qc_missing_baseline_found(spark, sf):
    """Q18 after the warm-up: days whose day of the last week has no row."""
    return QC.missing_baseline(K._alert(spark, sf, K.BWEEK, dense=False), after="1995-01-08")


# --------------------------------------------------------------------------
# Alerts by segment: own thresholds, drill-down with risk level
# --------------------------------------------------------------------------
SEGMENT_LIMITS = [("MACHINERY", 10.0, 20.0), ("HOUSEHOLD", 20.0, 40.0)]
_LIMITS_SQL = "VALUES " + ", ".join(f"('{s}', {w}, {c})" for s, w, c in SEGMENT_LIMITS)


@register("alert_segment_thresholds", K._alert_sql(by="customer_segment", per_scope=_LIMITS_SQL))
def q_alert_segment_thresholds(spark, sf):
    limits = literal_table(spark, SEGMENT_LIMITS, "customer_segment string, threshold_warning double, threshold_critical double")
    return K._alert(spark, sf, by=["customer_segment"], thresholds=limits)


@register("alert_drilldown_segment", O.with_(*K._hist_sql(True, "customer_segment"), O.alert_ctes(by="customer_segment"),
          O.facts_cte(), O.status_cte(K.REF, K.WIDE), O.risk_cte(), """hits AS (
  SELECT a.alert_date, a.customer_segment, a.severity, o.customer_id, MAX(o.order_date) AS last_order_date,
    SUM(o.order_amount) AS total_revenue
  FROM alerts a JOIN cust c ON c.customer_segment IS NOT DISTINCT FROM a.customer_segment
  JOIN ord o ON o.customer_id = c.customer_id AND o.order_date <= a.alert_date
  WHERE a.alert_flag GROUP BY ALL)""") + f"""SELECT h.alert_date, h.customer_segment, h.severity, h.customer_id, h.last_order_date,
  h.alert_date - h.last_order_date AS days_since_last_order, 'AT_RISK' AS retention_status, {O.cents('h.total_revenue')},
  r.churn_risk_level
FROM hits h LEFT JOIN risk r USING (customer_id) WHERE h.alert_date - h.last_order_date BETWEEN 31 AND 90""")
def q_alert_drilldown_segment(spark, sf):
    by = ["customer_segment"]
    alerts, _, _, _, iv = K._alerts_and_intervals(spark, sf, by)
    risk = RK.churn_detection(K._facts(spark, sf), K.REF, K.WIDE)
    hits = CP.alert_drilldown(alerts, None, intervals=iv, by=by, risk=risk)
    return hits.withColumn("total_revenue", money("total_revenue", 2))


# --------------------------------------------------------------------------
# Campaign outcome, and the forecast from the latest cohorts
# --------------------------------------------------------------------------
@register("campaign_conversion", O.with_(*K._two_snapshots_sql(K.EV_WEEK_AGO, K.EV_REF, "events", K.TIGHT, True)) + """SELECT
  r1.churn_risk_level AS targeted_level, COUNT(*) AS targeted, COUNT(*) FILTER (r2.churn_risk_level = 'LOW') AS converted,
  ROUND(100.0 * COUNT(*) FILTER (r2.churn_risk_level = 'LOW')::DOUBLE / COUNT(*)::DOUBLE, 1) AS conversion_pct
FROM r1 LEFT JOIN r2 USING (customer_id) WHERE r1.churn_risk_level <> 'LOW' GROUP BY 1""")
def q_campaign_conversion(spark, sf):
    before, after = K.two_risks(spark, sf)
    return CP.targeted_conversion(before.where("churn_risk_level <> 'LOW'"), after)


@register("forecast_latest_weighted", O.with_(*_BASE, O.cohort_ctes()).rstrip("\n") + f""", newest AS (
  SELECT * FROM cohort_cells QUALIFY row_number() OVER (PARTITION BY months_since_acquisition ORDER BY cohort_month DESC) <= 6),
curve AS (SELECT months_since_acquisition AS m, ROUND(SUM(retention_rate * cohort_size) / SUM(cohort_size), 6) AS rate
          FROM newest GROUP BY 1),
plan AS (SELECT CAST(p AS DATE) AS plan_month, CAST(n AS BIGINT) AS new_customers, 'base' AS scenario
         FROM (VALUES {", ".join(f"('{p}', {n})" for p, n in K.PLAN)}) x(p, n))
SELECT scenario, plan_month, m AS months_since_acquisition, CAST(plan_month + to_months(CAST(m AS INTEGER)) AS DATE) AS revenue_month,
  new_customers * (LEAST(rate, 100.0) / 100.0) AS expected_active,
  new_customers * (LEAST(rate, 100.0) / 100.0) * 1000.0 AS expected_revenue
FROM plan, curve""")
def q_forecast_latest_weighted(spark, sf):
    plan = literal_table(spark, [(p, n, "base", 1.0) for p, n in K.PLAN],
                         "plan_month date, new_customers long, scenario string, multiplier double")
    return CH.forecast(K._coh(spark, sf), plan, aov=1000.0, latest_cohorts=6, weighted=True)


# --------------------------------------------------------------------------
# A business model end to end: its status days, cohort window and baseline
# --------------------------------------------------------------------------
def _register_model(name):
    model = C.MODELS[name]
    hist = [O.ord_cte(), O.cust_cte(), O.history_ctes(K.H_START, K.H_END, model.thresholds, dense=True)]

    @register(f"model_{name}_alerts", O.with_(*hist, O.alert_ctes(model.alert)) + "SELECT * FROM alerts")
    def q_alerts(spark, sf):
        return K._alert_out(AL.alert_logic(K._hist(spark, sf, dense=True, th=model.thresholds), model.alert))

    @register(f"model_{name}_cohorts", O.with_(*_BASE, O.cohort_ctes())
              + f"SELECT * FROM cohort_cells WHERE months_since_acquisition <= {model.cohort_months}")
    def q_cohorts(spark, sf):
        return CH.cohort_retention(src.orders(spark, sf), max_months=model.cohort_months)


for _name in ("saas", "luxury", "fast_fashion"):
    _register_model(_name)


# --------------------------------------------------------------------------
# State kept from batch to batch: profile, ledger and daily series. The last
# days arrive in two batches, with late and repeated rows; the oracles read
# all rows that were delivered at once.
# --------------------------------------------------------------------------
from cohortwise.streaming import incremental as INC  # noqa: E402

EARLY, MIDDLE = "2000-12-31", "2001-04-30"
_DELIVERED = O.ord_cte("once") + f""",
ord AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE order_date > {O.d(MIDDLE)} AND order_id % 5 = 0)"""


def batches(orders):
    """Orders as they arrive: the history without every 7th order, a batch with
    some of those late, and the last one with the others and rows repeated."""
    late, last = F.col("order_id") % 7 == 0, F.col("order_date") > F.lit(MIDDLE).cast("date")
    early = F.col("order_date") <= F.lit(EARLY).cast("date")
    first = early & ~late
    second = ~last & ~first & ((F.col("order_id") % 14 != 0) | ~early)
    repeated = orders.where(last & (F.col("order_id") % 5 == 0))
    return [orders.where(first), orders.where(second), orders.where(~first & ~second).unionByName(repeated)]


def _merged(spark, sf, series=None):
    table = _path(spark, "profile")
    for epoch, batch in enumerate(batches(src.orders(spark, sf))):
        INC.merge_profile_epoch(spark, table, epoch, batch, src.customers(spark, sf), series=series)
    return table


@register("incremental_profile", O.with_(_DELIVERED, O.cust_cte(), O.facts_cte()) + f"SELECT {K._FACT_SEL} FROM buyer")
def q_incremental_profile(spark, sf):
    """Facts off a profile merged three times, no batch reading older orders."""
    from cohortwise.operators.profile import facts_from_profile

    return K._money_facts(facts_from_profile(INC.read_profile_version(spark, _merged(spark, sf))))


@register("incremental_history", O.with_(_DELIVERED, O.history_ctes(K.H_START, K.H_END, dense=True)) + "SELECT * FROM hist")
def q_incremental_history(spark, sf):
    """The daily history off the series that the merges retract from and add to."""
    return INC.read_daily_history(spark, _merged(spark, sf, C.StatusThresholds()), K.H_START, K.H_END, dense=True)


# --------------------------------------------------------------------------
# Layers published together, and layers stored alike
# --------------------------------------------------------------------------
from cohortwise.plans import daily as DY  # noqa: E402
from cohortwise.sources import publication as PB  # noqa: E402


@register("published_risk", O.with_(
    O.cust_cte(), O.ord_cte("o1", as_of=K.PAST), O.facts_cte("f1", "o1"), O.status_cte(K.PAST, name="s1", facts="f1"), O.risk_cte(name="r1", facts="f1", snap="s1"),
    O.ord_cte("o2", as_of="2001-01-02"), O.facts_cte("f2", "o2"), O.status_cte("2001-01-02", name="s2", facts="f2"), O.risk_cte(name="r2", facts="f2", snap="s2"))
    + " UNION ALL ".join(f"SELECT {K._RISK_SEL}, {O.d(day)} AS snapshot_date FROM r{i}" for i, day in ((1, K.PAST), (2, "2001-01-02"))))
def q_published_risk(spark, sf):
    """X25 / SNK1-4: two days published, the second broken off half way and run again."""
    root, o, c = _path(spark, "published"), src.orders(spark, sf), src.customers(spark, sf)
    DY.publish_day(spark, o, c, K.PAST, root)
    try:
        DY.publish_day(spark, o, c, "2001-01-02", root, fail_after="risk")
    except RuntimeError:
        pass
    DY.publish_day(spark, o, c, "2001-01-02", root)
    risk = PB.Publication(spark, root).read("risk")
    return K._money_facts(risk.select(*RK.RISK_COLUMNS, "snapshot_date"))


LAYER_BUCKETS = 8


@register("table_risk_copartitioned", K._risk_sql(K.REF, K.WIDE))
def q_table_risk_copartitioned(spark, sf):
    """J2 / SRC3-4: stored facts and the stored snapshot, in buckets alike: the join moves nothing."""
    f, names = K._facts(spark, sf), []
    for name, layer, by in (("facts", f, None), ("snapshots", ST.retention_status(f, K.REF, K.WIDE).unionByName(
            ST.retention_status(f, K.PAST, K.WIDE)), "snapshot_date")):
        names.append(f"{name}_{uuid.uuid4().hex}")
        PB.write_copartitioned(layer, names[-1], _path(spark, name), LAYER_BUCKETS, by)
    facts, snapshots = (spark.table(n) for n in names)
    return K._money_facts(RK.churn_detection(facts, K.REF, snapshot=snapshots.hint("merge")))


# --------------------------------------------------------------------------
# Campaign lists, kept days, subscriptions, deviations
# --------------------------------------------------------------------------
LIST_SCHEMA = "customer_id long, retention_status string, churn_risk_level string, total_revenue double, action string"


@register("table_campaign_list", O.with_(*K._RISKW) + f"""SELECT r.customer_id, r.retention_status, r.churn_risk_level,
  {O.cents('r.total_revenue')}, COALESCE(m.action, '{CP.DEFAULT_ACTION}') AS action
FROM risk r LEFT JOIN ({K._ACT_VALUES}) m(retention_status, churn_risk_level, action)
  ON r.retention_status = m.retention_status AND r.churn_risk_level = m.churn_risk_level""")
def q_table_campaign_list(spark, sf):
    """SNK5: the action list exported for a CRM (a first export is replaced), read back from its files."""
    path = _path(spark, "campaign")
    actions = CP.apply_action_matrix(K._riskdf(spark, sf, K.WIDE), CP.action_matrix_df(spark))
    wanted = actions.select("customer_id", "retention_status", "churn_risk_level", money("total_revenue", 2).alias("total_revenue"), "action")
    CP.export_customer_list(wanted.where("churn_risk_level = 'HIGH'"), path)
    CP.export_customer_list(wanted, path)
    return CP.read_customer_list(spark, path, LIST_SCHEMA)


@register("table_kept_snapshots", O.with_(*_BASE, O.status_cte("2001-05-02", name="d1"), O.status_cte(K.REF, name="d2"))
          + "SELECT * FROM d1 UNION ALL SELECT * FROM d2")
def q_table_kept_snapshots(spark, sf):
    """Of three daily snapshots the one beyond 90 days is dropped."""
    path, f = _path(spark, "snapshots"), K._facts(spark, sf)
    for day in (K.PAST, "2001-05-02", K.REF):
        T.write_snapshot(ST.retention_status(f, day), path)
    T.keep_recent(spark, path, K.REF, 90)
    return spark.read.parquet(path).select(*ST.STATUS_COLUMNS)


@register("subscription_status", O.with_(O.ord_cte()) + f"""SELECT customer_id, renewal - {O.d(K.REF)} AS days_to_renewal,
  CASE WHEN cancelled <= {O.d(K.REF)} THEN 'CANCELLED' WHEN renewal - {O.d(K.REF)} <= 30 THEN 'RENEWAL_DUE' ELSE 'ACTIVE' END
    AS subscription_status
FROM (SELECT customer_id, CAST(MAX(order_date) + INTERVAL 12 MONTH AS DATE) AS renewal,
        CASE WHEN max_by(order_status, (order_date, order_id)) = 'F' THEN MAX(order_date) + 60 END AS cancelled FROM ord GROUP BY 1)""")
def q_subscription_status(spark, sf):
    """Subscriptions that the latest orders stand for, at the reference date."""
    return CP.subscription_status(src.subscriptions(spark, sf), K.REF)


@register("qc_baseline_deviation", K._alert_sql().replace("SELECT * FROM alerts", """SELECT alert_date, baseline_value, current_value,
  ROUND(deviation, 6) AS deviation FROM (SELECT *, ABS(current_value - baseline_value) AS deviation FROM alerts) WHERE deviation >= 3"""))
def q_qc_baseline_deviation(spark, sf):
    """Days whose share lies three points or more from its baseline."""
    return QC.baseline_deviation(K._alert(spark, sf), 3.0).withColumn("deviation", F.round("deviation", 6))


# --------------------------------------------------------------------------
# The alert as a stream
# --------------------------------------------------------------------------
from cohortwise.streaming import alerts as SA  # noqa: E402


@register("alert_stream_events", O.with_(*K._EV_HIST_SQL, O.alert_ctes(K.EV_ALERT)) + "SELECT * FROM alerts")
def q_alert_stream_events(spark, sf):
    """A2 / A4: the daily shares streamed in by thirds, the middle one last; the newest judgement of every day."""
    root = _path(spark, "alert-stream")
    days = K.stored(K._ev_hist(spark, sf), "distribution")
    third = F.floor(F.datediff("snapshot_date", F.lit(K.EV_START).cast("date")) / 11)
    for part in (0, 2, 1):
        days.where(third == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in days.schema.fields)
        SA.start_alert_stream(spark, f"{root}/in", schema, f"{root}/out", f"{root}/checkpoint", K.EV_ALERT).awaitTermination()
    return K._alert_out(SA.read_alerts(spark, f"{root}/out"))


# --------------------------------------------------------------------------
# All checks of a layer in one pass
# --------------------------------------------------------------------------
from cohortwise.operators import layer_checks as LC  # noqa: E402

_TWO_DAYS = O.with_(*_BASE, O.status_cte(K.PAST, name="d1"), O.status_cte(K.REF, K.WIDE, name="d2"),
                    "both_days AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2)")


def _checks_sql(distinct: bool) -> str:
    per = "FROM both_days GROUP BY retention_status"
    rows = [f"SELECT 'Q4' AS check_id, retention_status AS item, 'customer_count' AS metric, COUNT(*)::DOUBLE AS value {per}",
            f"SELECT 'Q6', retention_status, 'min_days', MIN(days_since_last_order)::DOUBLE {per}",
            f"SELECT 'Q6', retention_status, 'max_days', MAX(days_since_last_order)::DOUBLE {per}"]
    wanted = {"min_days": "MIN(days_since_last_order)", "max_days": "MAX(days_since_last_order)", "total_rows": "COUNT(*)",
              "future_orders": "COUNT(*) FILTER (days_since_last_order < 0)"}
    if distinct:
        wanted["unique_customers"] = "COUNT(DISTINCT customer_id)"
        rows.append("""SELECT 'Q7', 'all', 'multi_status_customers', COUNT(*)::DOUBLE FROM (SELECT 1 FROM both_days
  GROUP BY customer_id, snapshot_date HAVING COUNT(DISTINCT retention_status) > 1)""")
    rows += [f"SELECT 'Q5', 'all', '{m}', {x}::DOUBLE FROM both_days" for m, x in wanted.items()]
    return _TWO_DAYS + " UNION ALL ".join(rows)


def _two_days(spark, sf):
    f = K._facts(spark, sf)
    return ST.retention_status(f, K.PAST).unionByName(ST.retention_status(f, K.REF, K.WIDE))


@register("snapshot_checks", _checks_sql(distinct=True))
def q_snapshot_checks(spark, sf):
    """Q4 to Q7 of two stored days from one scan of them."""
    path = _path(spark, "snapshots")
    T.write_snapshot(_two_days(spark, sf), path)
    return LC.snapshot_checks(T.read_snapshot(spark, path))


@register("snapshot_checks_observed", _checks_sql(distinct=False))
def q_snapshot_checks_observed(spark, sf):
    """Q4 to Q6 counted while the layer is written."""
    path = _path(spark, "snapshots")
    return LC.write_observed(_two_days(spark, sf), lambda df: T.write_snapshot(df, path))


@register("risk_checks", O.with_(*_BASE, O.status_cte(K.REF, K.WIDE), O.risk_cte()) + """SELECT 'Q8' AS check_id, churn_risk_level AS item,
  'customer_count' AS metric, COUNT(*)::DOUBLE AS value FROM risk GROUP BY 2
UNION ALL SELECT 'Q9', concat(retention_status, '|', churn_risk_level), 'customer_count', COUNT(*)::DOUBLE FROM risk GROUP BY 2
UNION ALL SELECT 'Q11', 'all', 'out_of_range', COUNT(*) FILTER (churn_risk_score NOT BETWEEN 0 AND 100)::DOUBLE FROM risk""")
def q_risk_checks(spark, sf):
    return LC.risk_checks(K._riskdf(spark, sf, K.WIDE))
