"""Queries over customer runs: risk by day, daily flows, snapshots stored as
intervals; each of their oracles computes the as-of facts of every customer on
every day. Cohorts over several dimensions from stored bitmaps, and trailing
windows from stored running totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise import config as C
from cohortwise.functions.dates import date_lit
from cohortwise.functions.numeric import money
from cohortwise.operators import alerts as AL
from cohortwise.operators import campaigns as CP
from cohortwise.operators import cohort_cube as CC
from cohortwise.operators import cohorts as CH
from cohortwise.operators import history as HI
from cohortwise.operators import risk as RK
from cohortwise.operators import runs as RU
from cohortwise.operators import trailing as TR
from cohortwise.plans import catalog as K
from cohortwise.plans import oracle as O
from cohortwise.plans.catalog_tables import _path
from cohortwise.sources import tables as T
from cohortwise.sources import testdata as src

register = K.register


def every_day(start: str, end: str, th: C.StatusThresholds, w: C.RiskWeights = C.RiskWeights(), source: str = "orders",
              before: int = 0) -> str:
    """``day_risk``: status, score and level of every customer on every day of
    [start - before, end]."""
    late = "COALESCE(total_orders > 1 AND 100 * idle * (total_orders - 1) > {p} * (last_order_date - first_order_date), FALSE)"
    return O.with_(O.ord_cte(source=source), f"""cal AS (SELECT CAST(x AS DATE) AS snapshot_date
  FROM range({O.d(start)} - INTERVAL {before} DAY, {O.d(end)} + INTERVAL 1 DAY, INTERVAL 1 DAY) t(x))""", """upto AS (
  SELECT c.snapshot_date, o.customer_id, MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date,
    COUNT(DISTINCT o.order_id) AS total_orders, SUM(o.order_amount) AS total_revenue
  FROM cal c JOIN ord o ON o.order_date <= c.snapshot_date GROUP BY 1, 2 HAVING COUNT(DISTINCT o.order_id) > 0)""", f"""seen AS (
  SELECT *, {O.status_of('idle', th.active_days, th.at_risk_days)} AS retention_status
  FROM (SELECT *, snapshot_date - last_order_date AS idle FROM upto))""", f"""points AS (
  SELECT *, CAST({late.format(p=w.frequency_factor_pct)}::INT * {w.frequency_drop} + COALESCE(retention_status = 'ACTIVE' AND (
    total_orders <= {w.low_orders_max} OR {late.format(p=w.inconsistency_factor_pct)}), FALSE)::INT * {w.status_inconsistent} AS INTEGER)
    AS churn_risk_score FROM seen)""", f"""day_risk AS (
  SELECT *, {O.level_of('churn_risk_score', w.medium_min, w.high_min)} AS churn_risk_level FROM points)""")


def _levels_sql(key: str | None = None, select: str | None = None) -> str:
    k, part = (f"{key}, ", f"{key}, snapshot_date") if key else ("", "snapshot_date")
    return f"""SELECT {k}snapshot_date, churn_risk_level, COUNT(*) AS customer_count,
  CAST(SUM(COUNT(*)) OVER (PARTITION BY {part}) AS BIGINT) AS total_customers,
  ROUND(100.0 * COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY {part})::DOUBLE, 2) AS level_pct
FROM (SELECT *{', ' + select if select else ''} FROM day_risk) GROUP BY {k}snapshot_date, churn_risk_level"""


def _runs(spark, sf, th, source="orders", end=None):
    o = src.orders(spark, sf) if source == "orders" else src.event_purchases(spark, sf)
    return RU.risk_runs(RU.order_day_facts(o, end), th)


# --------------------------------------------------------------------------
# Risk on every day
# --------------------------------------------------------------------------
@register("risk_history", every_day(K.H_START, K.H_END, K.WIDE) + _levels_sql("retention_status"))
def q_risk_history(spark, sf):
    """Levels within each status on all days of the orders table."""
    return RU.risk_history(_runs(spark, sf, K.WIDE, end=K.H_END), K.H_START, K.H_END, by=["retention_status"])


@register("risk_history_events", every_day(K.EV_START, K.EV_END, K.TIGHT, source="events") + _levels_sql())
def q_risk_history_events(spark, sf):
    return RU.risk_history(_runs(spark, sf, K.TIGHT, "events", K.EV_END), K.EV_START, K.EV_END)


Q_START = "2001-01-01"


@register("risk_history_cohorts", every_day(Q_START, K.H_END, K.WIDE)
          + _levels_sql("cohort_month", "CAST(date_trunc('month', first_order_date) AS DATE) AS cohort_month"))
def q_risk_history_cohorts(spark, sf):
    """X27 by day: levels within each acquisition cohort."""
    runs = RU.with_cohort_month(_runs(spark, sf, K.WIDE, end=K.H_END))
    return RU.risk_history(runs, Q_START, K.H_END, by=["cohort_month"])


@register("score_changes_events", every_day(K.EV_START, K.EV_END, K.TIGHT, source="events", before=1) + f"""SELECT customer_id,
  snapshot_date AS change_date, retention_status, previous_score, previous_level, churn_risk_score, churn_risk_level,
  churn_risk_score - COALESCE(previous_score, 0) AS score_change,
  churn_risk_score - COALESCE(previous_score, 0) >= 20 AS is_significant_increase
FROM (SELECT *, LAG(churn_risk_score) OVER w AS previous_score, LAG(churn_risk_level) OVER w AS previous_level FROM day_risk
      WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_date))
WHERE snapshot_date >= {O.d(K.EV_START)} AND previous_score IS DISTINCT FROM churn_risk_score""")
def q_score_changes_events(spark, sf):
    """Every customer's score changes in the month, on their days."""
    return RU.level_changes(_runs(spark, sf, K.TIGHT, "events", K.EV_END), K.EV_START, K.EV_END)


# --------------------------------------------------------------------------
# Flows between any two days in a row
# --------------------------------------------------------------------------
def _flow_sql(col: str, start: str) -> str:
    return f"""SELECT s.snapshot_date, COALESCE(p.{col}, '{RU.NOT_A_CUSTOMER}') AS from_{col}, s.{col} AS to_{col}, COUNT(*) AS customer_count
FROM day_risk s LEFT JOIN day_risk p ON p.customer_id = s.customer_id AND p.snapshot_date = s.snapshot_date - INTERVAL 1 DAY
WHERE s.snapshot_date >= {O.d(start)} GROUP BY 1, 2, 3"""


@register("flow_matrix", every_day(K.H_START, K.H_END, C.StatusThresholds(), before=1) + _flow_sql("retention_status", K.H_START))
def q_flow_matrix(spark, sf):
    runs = RU.status_runs(HI.order_day_intervals(src.orders(spark, sf), K.H_END))
    return RU.flow_matrix(runs, K.H_START, K.H_END)


@register("flow_matrix_levels", every_day(K.EV_START, K.EV_END, K.TIGHT, source="events", before=1)
          + _flow_sql("churn_risk_level", K.EV_START))
def q_flow_matrix_levels(spark, sf):
    return RU.flow_matrix(_runs(spark, sf, K.TIGHT, "events", K.EV_END), K.EV_START, K.EV_END, "churn_risk_level")


# --------------------------------------------------------------------------
# Snapshots stored as intervals
# --------------------------------------------------------------------------
def _days_sql(days: list[str], th: C.StatusThresholds = C.StatusThresholds()) -> str:
    ctes = [O.cust_cte()]
    for i, day in enumerate(days):
        ctes += [O.ord_cte(f"o{i}", as_of=day), O.facts_cte(f"f{i}", f"o{i}"), O.status_cte(day, th, f"s{i}", f"f{i}")]
    return O.with_(*ctes) + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(len(days)))


@register("table_snapshot_runs", _days_sql([K.PAST, "2001-03-15", K.REF]))
def q_table_snapshot_runs(spark, sf):
    """SNK2 / SRC4: three days read off the interval table."""
    path = _path(spark, "snapshot-runs")
    T.write_snapshot_runs(RU.status_runs(HI.order_day_intervals(src.orders(spark, sf))), path)
    return T.read_snapshot_days(spark, path, [K.PAST, "2001-03-15", K.REF])


@register("table_runs_expired", _days_sql(["2001-05-02", K.REF]))
def q_table_runs_expired(spark, sf):
    """Runs that ended before the last 90 days are dropped; the days kept read as before."""
    path = _path(spark, "snapshot-runs")
    T.write_snapshot_runs(RU.status_runs(HI.order_day_intervals(src.orders(spark, sf))), path)
    T.expire_runs(spark, path, K.REF, 90)
    return T.read_snapshot_days(spark, path, ["2001-05-02", K.REF])


@register("risk_asof_runs", O.with_(
    O.cust_cte(), O.ord_cte("o1", as_of=K.PAST), O.facts_cte("f1", "o1"), O.status_cte(K.PAST, K.WIDE, "s1", "f1"), O.risk_cte(name="r1", facts="f1", snap="s1"),
    O.ord_cte("o2", as_of=K.REF), O.facts_cte("f2", "o2"), O.status_cte(K.REF, K.WIDE, "s2", "f2"), O.risk_cte(name="r2", facts="f2", snap="s2"))
    + " UNION ALL ".join(f"SELECT {K._RISK_SEL}, {O.d(day)} AS snapshot_date FROM r{i}" for i, day in ((1, K.PAST), (2, K.REF))))
def q_risk_asof_runs(spark, sf):
    """The risk layer of two days, replayed from one table of risk runs."""
    return K._money_facts(RU.risk_as_of(_runs(spark, sf, K.WIDE), [K.PAST, K.REF]))


# --------------------------------------------------------------------------
# Drill-down of alerts into a stored table of risk runs
# --------------------------------------------------------------------------
@register("alert_drilldown_risk", every_day(K.EV_START, K.EV_END, K.TIGHT, source="events").rstrip() + "," + O.history_ctes(
    K.EV_START, K.EV_END, K.TIGHT, dense=True).replace("cal AS", "cal2 AS", 1).replace("FROM cal c", "FROM cal2 c") + ","
    + O.alert_ctes(K.EV_ALERT) + f""" SELECT alert_date, severity, customer_id, last_order_date, idle AS days_since_last_order, retention_status,
  {O.cents('total_revenue')}, churn_risk_score, churn_risk_level
FROM alerts JOIN day_risk ON snapshot_date = alert_date WHERE alert_flag AND retention_status = 'AT_RISK'""")
def q_alert_drilldown_risk(spark, sf):
    """Alerts over purchase events, and the customers behind them with the risk they had on the day."""
    path = _path(spark, "risk-runs")
    T.write_snapshot_runs(_runs(spark, sf, K.TIGHT, "events", K.EV_END), path)
    runs = spark.read.parquet(path)
    status = runs.select("retention_status", "from_day", "to_day")
    history = HI.history_from_runs(status, K.EV_START, K.EV_END, dense=True)
    hits = CP.alert_drilldown_from_runs(AL.alert_logic(history, K.EV_ALERT), runs)
    return hits.withColumn("total_revenue", money("total_revenue", 2))


# --------------------------------------------------------------------------
# Cohorts by several dimensions at once
# --------------------------------------------------------------------------
DIMS = ["customer_segment", "country"]


def _cube_sql(months: int) -> str:
    keys = ", ".join(DIMS)
    return O.with_(O.ord_cte(), O.cust_cte(), """firsts AS (
  SELECT customer_id, CAST(date_trunc('month', MIN(order_date)) AS DATE) AS cohort_month FROM ord
  WHERE customer_id IS NOT NULL GROUP BY 1 HAVING COUNT(order_id) > 0 AND MIN(order_date) IS NOT NULL)""", f"""acts AS (
  SELECT f.cohort_month, {keys}, f.customer_id,
    CAST(date_diff('month', f.cohort_month, CAST(date_trunc('month', o.order_date) AS DATE)) // {months} AS BIGINT) AS period
  FROM firsts f JOIN ord o ON o.customer_id = f.customer_id AND o.order_date IS NOT NULL LEFT JOIN cust c ON c.customer_id = f.customer_id)""",
                   f"""cube_rows AS (
  SELECT CAST(GROUPING({keys}) AS BIGINT) AS "grouping", cohort_month, {keys}, period, COUNT(DISTINCT customer_id) AS active_customers
  FROM acts GROUP BY GROUPING SETS ((cohort_month, period), (cohort_month, period, {DIMS[0]}), (cohort_month, period, {DIMS[1]}),
    (cohort_month, period, {keys})))""", f"""sizes AS (
  SELECT CAST(GROUPING({keys}) AS BIGINT) AS "grouping", cohort_month, {keys}, COUNT(DISTINCT customer_id) AS cohort_size
  FROM acts GROUP BY GROUPING SETS ((cohort_month), (cohort_month, {DIMS[0]}), (cohort_month, {DIMS[1]}), (cohort_month, {keys})))""") + f"""
SELECT r."grouping", r.cohort_month, {', '.join('r.' + k for k in DIMS)}, r.period, s.cohort_size, r.active_customers,
  ROUND(100.0 * r.active_customers::DOUBLE / s.cohort_size::DOUBLE, 2) AS retention_rate
FROM cube_rows r JOIN sizes s ON s."grouping" = r."grouping" AND s.cohort_month = r.cohort_month
  AND {' AND '.join(f's.{k} IS NOT DISTINCT FROM r.{k}' for k in DIMS)}"""


def _parts(spark, sf):
    """Members and parts of the orders as they arrive: up to 2000, then the rest."""
    o, c = src.orders(spark, sf), src.customers(spark, sf)
    batches = [CH.customer_months(o.where(F.col("order_date") <= date_lit(K.PAST))),
               CH.customer_months(o.where(F.col("order_date") > date_lit(K.PAST)))]
    members = K.stored(CC.number_members(batches[0], c, DIMS), "members")
    first = K.stored(CC.activity_parts(batches[0], members, DIMS), "parts")
    members = K.stored(members.unionByName(CC.number_members(batches[1], c, DIMS, known=members)), "members")
    second = K.stored(CC.activity_parts(batches[1], members, DIMS), "parts")
    return first.unionByName(second)


@register("cohort_cube", _cube_sql(1))
def q_cohort_cube(spark, sf):
    """Every grouping set of two dimensions, from parts stored in two batches."""
    return CC.cohort_cube(_parts(spark, sf), DIMS)


@register("cohort_cube_quarters", _cube_sql(3))
def q_cohort_cube_quarters(spark, sf):
    """The same parts by quarters since acquisition: months merged by OR."""
    return CC.cohort_cube(_parts(spark, sf), DIMS, months_per_period=3)


# --------------------------------------------------------------------------
# Trailing windows
# --------------------------------------------------------------------------
WINDOWS, WINDOW_DAYS = (7, 14, 30), ("2024-01-15", K.EV_REF)


def _totals(spark, sf):
    return K.stored(TR.running_totals(src.engagement_events(spark, sf)), "totals")


@register("engagement_windows", f"""SELECT CAST(e.user_id AS BIGINT) AS customer_id, d.snapshot_date,
  {', '.join(f"COUNT(*) FILTER (CAST(e.ts AS DATE) > d.snapshot_date - {w}) AS events_{w}" for w in WINDOWS)}
FROM events e JOIN (SELECT CAST(x AS DATE) AS snapshot_date FROM (VALUES {', '.join(f"('{x}')" for x in WINDOW_DAYS)}) t(x)) d
  ON CAST(e.ts AS DATE) <= d.snapshot_date WHERE e.event_type <> 'purchase' GROUP BY 1, 2""")
def q_engagement_windows(spark, sf):
    """Three windows on two days, all from one table of running totals."""
    return TR.trailing_counts(_totals(spark, sf), list(WINDOW_DAYS), list(WINDOWS))


@register("engagement_risk_stored", K.CATALOG["engagement_risk"][1])
def q_engagement_risk_stored(spark, sf):
    """The engagement signal of the risk layer from the stored totals."""
    counts = TR.trailing_counts(_totals(spark, sf), [K.EV_REF], [K.ENGAGE_DAYS], name="engagement_events")
    eng = counts.withColumnRenamed(f"engagement_events_{K.ENGAGE_DAYS}", "engagement_events")
    return K._money_facts(RK.churn_detection(K._facts(spark, sf, source="events"), K.EV_REF, K.TIGHT, K.ENGAGE_W, engagement=eng,
                                             engagement_min_events=K.ENGAGE_MIN))
