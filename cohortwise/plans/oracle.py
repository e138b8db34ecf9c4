"""DuckDB SQL for every catalog entry, formulated independently of the Spark
plans: facts from per-customer lists, status and risk level as list positions,
cohort cells counted one by one, alert baselines by a self join on earlier
days, the daily history by brute force over every calendar day.

Conventions that make two engines agree: dates cast to DATE, integer sums cast
to BIGINT, shares in DOUBLE, exact integer comparisons for gap multiples, and
summed / averaged money rounded to 6 digits.
"""

from __future__ import annotations

from cohortwise.config import AlertConfig, RiskWeights, StatusThresholds

M = 6  # money digits, same as functions.numeric.MONEY_DIGITS


def d(x: str) -> str:
    return f"DATE '{x}'"


def ord_cte(name: str = "ord", source: str = "orders", as_of: str | None = None,
            statuses: list[str] | None = None) -> str:
    if source == "orders":
        sel = (
            "SELECT CAST(o_custkey AS BIGINT) AS customer_id, CAST(o_orderkey AS BIGINT) AS order_id, "
            "CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DOUBLE) AS order_amount, "
            "o_orderstatus AS order_status FROM orders"
        )
        conds = []
        if statuses is not None:
            conds.append("o_orderstatus IN (" + ", ".join(f"'{s}'" for s in statuses) + ")")
        if as_of is not None:
            conds.append(f"CAST(o_orderdate AS DATE) <= {d(as_of)}")
    else:  # purchase events
        sel = (
            "SELECT CAST(user_id AS BIGINT) AS customer_id, CAST(event_id AS BIGINT) AS order_id, "
            "CAST(ts AS DATE) AS order_date, CAST(value AS DOUBLE) AS order_amount, "
            "CAST(NULL AS VARCHAR) AS order_status FROM events"
        )
        conds = ["event_type = 'purchase'"]
        if as_of is not None:
            conds.append(f"CAST(ts AS DATE) <= {d(as_of)}")
    if conds:
        sel += " WHERE " + " AND ".join(conds)
    return f"{name} AS ({sel})"


def cust_cte(name: str = "cust") -> str:
    return (
        f"{name} AS (SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, CAST(NULL AS VARCHAR) AS customer_email, "
        "n.n_name AS country, c.c_mktsegment AS customer_segment, CAST(NULL AS VARCHAR) AS acquisition_channel, "
        "CAST(NULL AS DATE) AS signup_date FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"
    )


def facts_cte(name: str = "buyer", ord_name: str = "ord", cust_name: str = "cust",
              last_value: bool = False) -> str:
    """Each customer's orders as lists; the facts are read off the lists."""
    lv = ", max_by(order_amount, (order_date, order_id)) AS last_order_value" if last_value else ""
    lvo = ", p.last_order_value" if last_value else ""
    attributes = ", ".join(f"(SELECT any_value(c.{x}) FROM {cust_name} c WHERE c.customer_id = p.customer_id) AS {x}" for x in (
        "customer_email", "country", "customer_segment", "acquisition_channel", "signup_date"))
    return f"""{name}_pile AS (
  SELECT customer_id, list(order_date) AS days, list(order_id) AS ids, list(order_amount) AS amounts{lv}
  FROM {ord_name} GROUP BY customer_id),
{name} AS (
  SELECT p.customer_id, {attributes}, list_min(p.days) AS first_order_date, list_max(p.days) AS last_order_date,
         CAST(len(list_distinct(p.ids)) AS BIGINT) AS total_orders, list_sum(p.amounts) AS total_revenue,
         list_avg(p.amounts) AS avg_order_value{lvo}
  FROM {name}_pile p WHERE len(list_distinct(p.ids)) > 0 AND list_min(p.days) IS NOT NULL)"""


def status_of(days: str, active, at_risk) -> str:
    """A status by its position: one step further for every limit passed."""
    return (f"COALESCE((['DATA_QUALITY_ISSUE', 'ACTIVE', 'AT_RISK', 'INACTIVE'])[1 + ({days} >= 0)::INT + ({days} > {active})::INT "
            f"+ ({days} > {at_risk})::INT], 'INACTIVE')")


def status_cte(ref: str, th: StatusThresholds = StatusThresholds(), name: str = "day_status",
               facts: str = "buyer") -> str:
    return f"""{name} AS (
  SELECT customer_id, last_order_date, idle AS days_since_last_order,
         {status_of('idle', th.active_days, th.at_risk_days)} AS retention_status, {d(ref)} AS snapshot_date
  FROM (SELECT *, {d(ref)} - last_order_date AS idle FROM {facts}))"""


def level_of(score: str, medium, high) -> str:
    return f"(['LOW', 'MEDIUM', 'HIGH'])[1 + ({score} >= {medium})::INT + ({score} >= {high})::INT]"


def risk_cte(w: RiskWeights = RiskWeights(), name: str = "risk", facts: str = "buyer",
             snap: str = "day_status", value_drop: bool = False) -> str:
    """Signals as 0 / 1 numbers, so that the score is a weighted sum. A gap
    is longer than p % of the mean gap if idle * gaps * 100 > p * lifetime."""
    vd = f"COALESCE(last_order_value * 100.0 < avg_order_value * {w.value_factor_pct}.0, FALSE)" if value_drop else "FALSE"
    late = "COALESCE(total_orders > 1 AND 100 * idle * (total_orders - 1) > {p} * (last_order_date - first_order_date), FALSE)"
    return f"""{name}_marks AS (
  SELECT f.*, s.retention_status, s.days_since_last_order AS idle
  FROM {facts} f JOIN {snap} s USING (customer_id)),
{name}_hits AS (
  SELECT *, {late.format(p=w.frequency_factor_pct)} AS is_frequency_drop, {vd} AS is_value_drop,
    COALESCE(retention_status = 'ACTIVE' AND (total_orders <= {w.low_orders_max}
             OR {late.format(p=w.inconsistency_factor_pct)}), FALSE) AS is_status_inconsistent
  FROM {name}_marks),
{name} AS (
  SELECT customer_id, retention_status, idle AS days_since_last_order, total_orders, total_revenue, avg_order_value,
         is_frequency_drop, is_value_drop, is_status_inconsistent, points AS churn_risk_score,
         {level_of('points', w.medium_min, w.high_min)} AS churn_risk_level
  FROM (SELECT *, CAST(is_frequency_drop::INT * {w.frequency_drop} + is_value_drop::INT * {w.value_drop}
                       + is_status_inconsistent::INT * {w.status_inconsistent} AS INTEGER) AS points FROM {name}_hits))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def money(col: str, alias: str | None = None) -> str:
    return f"ROUND(CAST({col} AS DOUBLE), {M}) AS {alias or col.split('.')[-1]}"


def cents(col: str, alias: str | None = None) -> str:
    """Summed money at cents: a sum over many orders carries noise far
    above 1e-6 once it reaches ~1e9, while cents stay exact."""
    return f"ROUND(CAST({col} AS DOUBLE), 2) AS {alias or col.split('.')[-1]}"


# --------------------------------------------------------------------------
# Cohorts: every (cohort, month) cell counted on its own
# --------------------------------------------------------------------------


def cohort_ctes(by: str | None = None, facts: str = "buyer", ord_name: str = "ord", name: str = "cohort_cells") -> str:
    """``name``: the cohort table, with the optional extra key ``by`` of the facts."""
    k = f"{by}, " if by else ""
    same = f" AND m.{by} IS NOT DISTINCT FROM c.{by}" if by else ""
    return f"""members AS (
  SELECT DISTINCT {k}customer_id, CAST(DATE_TRUNC('month', first_order_date) AS DATE) AS cohort_month FROM {facts}),
seen_months AS (
  SELECT DISTINCT customer_id, CAST(DATE_TRUNC('month', order_date) AS DATE) AS seen FROM {ord_name}),
cells AS (
  SELECT DISTINCT {k}cohort_month, seen FROM members JOIN seen_months USING (customer_id) WHERE seen >= cohort_month),
counted_cells AS (
  SELECT {k}cohort_month, date_diff('month', cohort_month, seen) AS months_since_acquisition,
    (SELECT COUNT(DISTINCT m.customer_id) FROM members m WHERE m.cohort_month = c.cohort_month{same}) AS cohort_size,
    (SELECT COUNT(DISTINCT m.customer_id) FROM members m JOIN seen_months s ON s.customer_id = m.customer_id
     WHERE m.cohort_month = c.cohort_month AND s.seen = c.seen{same}) AS active_customers
  FROM cells c),
{name} AS (
  SELECT *, ROUND(100.0 * active_customers::DOUBLE / cohort_size::DOUBLE, 2) AS retention_rate FROM counted_cells)"""


# --------------------------------------------------------------------------
# Daily history by brute force: as-of facts for every calendar day
# (customers x days) — an independent formulation of history.status_history
# --------------------------------------------------------------------------


def calendar_cte(start: str, end: str, name: str = "cal") -> str:
    return (
        f"{name} AS (SELECT CAST(x AS DATE) AS snapshot_date "
        f"FROM range({d(start)}, {d(end)} + INTERVAL 1 DAY, INTERVAL 1 DAY) t(x))"
    )


def history_ctes(start: str, end: str, th: StatusThresholds = StatusThresholds(), dense: bool = False,
                 by: str | None = None, ord_name: str = "ord", cust_name: str = "cust") -> str:
    k = f"{by}, " if by else ""
    part = f"PARTITION BY {by}, snapshot_date" if by else "PARTITION BY snapshot_date"
    seg_join = f" LEFT JOIN {cust_name} cu ON cu.customer_id = a.customer_id" if by else ""
    seg_col = f"cu.{by}, " if by else ""
    ctes = [
        calendar_cte(start, end),
        f"""asof_facts AS (
  SELECT c.snapshot_date, o.customer_id, MAX(o.order_date) AS last_order_date
  FROM cal c JOIN {ord_name} o ON o.order_date <= c.snapshot_date
  GROUP BY c.snapshot_date, o.customer_id
  HAVING COUNT(DISTINCT o.order_id) >= 1)""",
        f"""snap AS (
  SELECT {seg_col}a.snapshot_date, a.customer_id,
    {status_of('(a.snapshot_date - a.last_order_date)', th.active_days, th.at_risk_days)} AS retention_status
  FROM asof_facts a{seg_join})""",
        f"""counts AS (
  SELECT {k}snapshot_date, retention_status, COUNT(*) AS customer_count FROM snap GROUP BY {k}snapshot_date, retention_status)""",
    ]
    if dense:
        scopes = f" CROSS JOIN (SELECT DISTINCT {by} FROM snap) sc" if by else ""
        on_by = f" AND g.{by} IS NOT DISTINCT FROM n.{by}" if by else ""
        gk = f"g.{by}, " if by else ""
        ctes.append(f"""grid AS (
  SELECT {('sc.' + by + ', ') if by else ''}c.snapshot_date, s.retention_status FROM cal c
  CROSS JOIN (VALUES ('ACTIVE'), ('AT_RISK'), ('INACTIVE')) s(retention_status){scopes}),
counts2 AS (
  SELECT {gk}g.snapshot_date, g.retention_status, CAST(COALESCE(n.customer_count, 0) AS BIGINT) AS customer_count
  FROM grid g LEFT JOIN counts n ON g.snapshot_date = n.snapshot_date AND g.retention_status = n.retention_status{on_by})""")
        src = "counts2"
    else:
        src = "counts"
    ctes.append(f"""hist AS (
  SELECT {k}snapshot_date, retention_status, customer_count,
    CAST(SUM(customer_count) OVER ({part}) AS BIGINT) AS total_customers,
    ROUND(CAST(customer_count AS DOUBLE) * 100.0 / CAST(NULLIF(SUM(customer_count) OVER ({part}), 0) AS DOUBLE), 2) AS status_pct
  FROM {src})""")
    return ",\n".join(ctes)


def alert_ctes(cfg: AlertConfig = AlertConfig(), hist: str = "hist", by: str | None = None,
               seasonal: str | None = None, campaigns: list[tuple[str, str]] | None = None,
               complete_before: str | None = None, per_scope: str | None = None, name: str = "alerts") -> str:
    """The monitored series numbered by day; each day joined to the earlier
    days of its baseline. ``+ 0.0`` turns a rounded negative zero into 0.0
    (Spark's decimal rounding has none). ``per_scope``: thresholds per ``by``."""
    k, pk = (f"{by}, " if by else ""), (f"PARTITION BY {by} " if by else "")
    same = f" AND e.{by} IS NOT DISTINCT FROM n.{by}" if by else ""
    cut = f" AND snapshot_date < {d(complete_before)}" if complete_before else ""
    earlier = {
        "rows": f"e.nth BETWEEN n.nth - {cfg.baseline_rows} AND n.nth - 1",
        "median": f"e.nth BETWEEN n.nth - {cfg.baseline_rows} AND n.nth - 1",
        "range": f"e.snapshot_date BETWEEN n.snapshot_date - INTERVAL {cfg.baseline_rows} DAY AND n.snapshot_date - INTERVAL 1 DAY",
        "same_day_last_week": "e.snapshot_date = n.snapshot_date - INTERVAL 7 DAY",
    }[cfg.baseline]
    centre = "median(e.status_pct)" if cfg.baseline == "median" else "AVG(e.status_pct)"
    limits = [f"CAST({cfg.warning_pct} AS DOUBLE)", f"CAST({cfg.critical_pct} AS DOUBLE)"]
    for table, on in ((seasonal, "t.k = month(m.snapshot_date)"), (per_scope, f"t.k IS NOT DISTINCT FROM m.{by}")):
        if table:
            limits = [f"COALESCE((SELECT t.{c} FROM ({table}) t(k, lw, lc) WHERE {on}), {x})" for c, x in zip(("lw", "lc"), limits)]
    worse = "rel" if cfg.direction == "increase" else "-rel"
    raised = "loud"
    if cfg.consecutive_days > 1:
        raised = (f"loud AND COALESCE((SELECT COUNT(*) = {cfg.consecutive_days - 1} FROM judged e WHERE e.loud AND e.snapshot_date BETWEEN "
                  f"n.snapshot_date - INTERVAL {cfg.consecutive_days - 1} DAY AND n.snapshot_date - INTERVAL 1 DAY{same}), FALSE)")
    quiet = " OR ".join(f"n.snapshot_date BETWEEN {d(x)} AND {d(y)}" for x, y in campaigns or [])
    flag = f"({raised}) AND NOT ({quiet}) AS alert_flag, ({quiet}) AS suppressed" if campaigns else f"({raised}) AS alert_flag"
    scope = f"CAST({by} AS VARCHAR)" if by else f"'{cfg.scope}'"
    return f"""monitored AS (
  SELECT *, row_number() OVER ({pk}ORDER BY snapshot_date) AS nth FROM {hist} WHERE retention_status = '{cfg.status}'{cut}),
measured AS (
  SELECT n.*, CASE WHEN past.days >= {cfg.min_history} THEN past.level END AS usual
  FROM monitored n LEFT JOIN (
    SELECT {('n.' + by + ' AS scope_key, ') if by else ''}n.nth, {centre} AS level, COUNT(e.status_pct) AS days
    FROM monitored n JOIN monitored e ON {earlier}{same} GROUP BY ALL) past
    ON past.nth = n.nth{f' AND past.scope_key IS NOT DISTINCT FROM n.{by}' if by else ''}),
judged AS (
  SELECT *, (total_customers >= {cfg.min_sample} AND usual IS NOT NULL AND severity <> 'INFO') IS TRUE AS loud FROM (
    SELECT *, COALESCE((['INFO', 'WARNING', 'CRITICAL'])[1 + ({worse} >= lw OR {worse} >= lc)::INT + ({worse} >= lc)::INT], 'INFO') AS severity
    FROM (SELECT m.*, ROUND((m.status_pct / NULLIF(m.usual, 0) - 1) * 100, 2) AS rel, {limits[0]} AS lw, {limits[1]} AS lc
          FROM measured m))),
{name} AS (
  SELECT {k}snapshot_date AS alert_date, '{cfg.alert_type}' AS alert_type, '{cfg.metric_name}' AS metric_name,
    {scope} AS scope, status_pct AS current_value, ROUND(usual, {M}) AS baseline_value,
    ROUND(status_pct - usual, {M}) + 0.0 AS delta_pct, rel + 0.0 AS delta_relative_pct, lw AS threshold_warning,
    lc AS threshold_critical, severity, {flag}, total_customers AS sample_size
  FROM judged n)"""
