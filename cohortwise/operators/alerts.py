"""Layer 5 — alerts comparing a status share with its recent baseline.

Input is a daily distribution (``history.status_history`` or
``history.snapshot_distribution``): one row per (scope, day, status), so
every window here is partitioned by (scope, status) and holds one row per
calendar day — the series is tiny whatever the number of customers.

Order of rounding follows the reference: shares are rounded to 2 digits
before the baseline averages them; ``delta_pct`` is unrounded;
``delta_relative_pct`` is rounded to 2 digits *before* the threshold test
(20 -> 23 is exactly 15.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.config import CRITICAL, INFO, WARNING, AlertConfig

ALERT_COLUMNS = [
    "alert_date",
    "alert_type",
    "metric_name",
    "scope",
    "current_value",
    "baseline_value",
    "delta_pct",
    "delta_relative_pct",
    "threshold_warning",
    "threshold_critical",
    "severity",
    "alert_flag",
    "sample_size",
]


def _day(c: str = "snapshot_date") -> Column:
    return F.unix_date(F.col(c)).cast("long")


def _baseline(cfg: AlertConfig, keys: list[str]) -> tuple[Column, Column]:
    """(baseline value, number of history rows it used)."""
    k = int(cfg.baseline_rows)
    part = Window.partitionBy(*keys, "retention_status")
    if cfg.baseline == "rows":
        w = part.orderBy("snapshot_date").rowsBetween(-k, -1)
        return F.avg("status_pct").over(w), F.count("status_pct").over(w)
    if cfg.baseline == "range":
        w = part.orderBy(_day()).rangeBetween(-k, -1)
        return F.avg("status_pct").over(w), F.count("status_pct").over(w)
    if cfg.baseline == "same_day_last_week":
        w = part.orderBy(_day()).rangeBetween(-7, -7)
        return F.avg("status_pct").over(w), F.count("status_pct").over(w)
    if cfg.baseline == "median":
        w = part.orderBy("snapshot_date").rowsBetween(-k, -1)
        xs = F.array_sort(F.collect_list("status_pct").over(w))
        n = F.size(xs)
        lo = F.element_at(xs, ((n + 1) / 2).cast("int"))
        hi = F.element_at(xs, (n / 2 + 1).cast("int"))
        med = F.when(n == 0, F.lit(None)).when(n % 2 == 1, lo).otherwise((lo + hi) / 2.0)
        return med.cast("double"), n.cast("long")
    raise ValueError(f"unknown baseline {cfg.baseline!r}")


def alert_logic(
    distribution: DataFrame,
    cfg: AlertConfig = AlertConfig(),
    by: list[str] | None = None,
    thresholds: DataFrame | None = None,
    complete_before=None,
) -> DataFrame:
    """A1-A6 over a daily distribution; one row per (scope, day) on which
    the monitored status has a row.

    ``by``: scope keys (the ``scope`` column then shows them, e.g. a
    segment); ``thresholds``: optional thresholds per month, per scope or both
    (``threshold_warning DOUBLE, threshold_critical DOUBLE`` with ``month INT``
    and / or columns of ``by``; at least one of them, one row per combination); ``complete_before``: days on or
    after this date are incomplete loads and are not evaluated."""
    keys = list(by or [])
    s = distribution.where(F.col("retention_status") == F.lit(cfg.status))
    if complete_before is not None:
        from cohortwise.functions.dates import date_lit

        s = s.where(F.col("snapshot_date") < date_lit(complete_before))
    base, n_hist = _baseline(cfg, keys)
    s = s.select("*", base.alias("_b"), n_hist.alias("_n"))
    s = s.withColumn("baseline_value", F.when(F.col("_n") >= int(cfg.min_history), F.col("_b")))
    if thresholds is None:
        s = s.withColumn("threshold_warning", F.lit(float(cfg.warning_pct))).withColumn(
            "threshold_critical", F.lit(float(cfg.critical_pct))
        )
    else:
        on = [k for k in ("month", *keys) if k in thresholds.columns]
        t = thresholds.select(
            *[F.col(k).alias(f"_on_{k}") for k in on],
            F.col("threshold_warning").cast("double").alias("_tw"),
            F.col("threshold_critical").cast("double").alias("_tc"),
        )
        match = [(F.month("snapshot_date") if k == "month" else F.col(k)).eqNullSafe(F.col(f"_on_{k}")) for k in on]
        s = s.join(t, match, "left").drop(*[f"_on_{k}" for k in on])
        s = s.withColumn("threshold_warning", F.coalesce("_tw", F.lit(float(cfg.warning_pct)))).withColumn(
            "threshold_critical", F.coalesce("_tc", F.lit(float(cfg.critical_pct)))
        )
    cur, bl = F.col("status_pct"), F.col("baseline_value")
    rel = F.round((cur / F.nullif(bl, F.lit(0.0)) - 1) * 100, 2)
    s = s.withColumn("delta_pct", cur - bl).withColumn("delta_relative_pct", rel)
    worse = F.col("delta_relative_pct") if cfg.direction == "increase" else -F.col("delta_relative_pct")
    sev = (
        F.when(worse >= F.col("threshold_critical"), F.lit(CRITICAL))
        .when(worse >= F.col("threshold_warning"), F.lit(WARNING))
        .otherwise(F.lit(INFO))
    )
    s = s.withColumn("severity", sev)
    raw = F.coalesce(
        (F.col("total_customers") >= int(cfg.min_sample))
        & bl.isNotNull()
        & F.col("severity").isin(WARNING, CRITICAL),
        F.lit(False),
    )
    s = s.withColumn("_raw", raw)
    if int(cfg.consecutive_days) > 1:
        k = int(cfg.consecutive_days) - 1
        w = Window.partitionBy(*keys, "retention_status").orderBy(_day()).rangeBetween(-k, -1)
        prev_ok = F.sum(F.col("_raw").cast("int")).over(w) == k
        s = s.withColumn("alert_flag", F.col("_raw") & F.coalesce(prev_ok, F.lit(False)))
    else:
        s = s.withColumn("alert_flag", F.col("_raw"))
    scope = F.lit(cfg.scope) if not keys else F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return s.select(
        *keys,
        F.col("snapshot_date").alias("alert_date"),
        F.lit(cfg.alert_type).alias("alert_type"),
        F.lit(cfg.metric_name).alias("metric_name"),
        scope.alias("scope"),
        F.col("status_pct").alias("current_value"),
        "baseline_value",
        "delta_pct",
        "delta_relative_pct",
        "threshold_warning",
        "threshold_critical",
        "severity",
        "alert_flag",
        F.col("total_customers").alias("sample_size"),
    )


def cohort_alert(cohorts: DataFrame, maturity: int = 1, cfg: AlertConfig | None = None) -> DataFrame:
    """X7 — young-cohort underperformance: each cohort's retention rate at
    ``maturity`` (M+1, M+2) against the mean of the previous
    ``cfg.baseline_rows`` cohorts at the same maturity; a *drop* alerts.
    The series has one row per cohort month (calendar-bounded)."""
    cfg = cfg or AlertConfig(
        status=f"M+{int(maturity)}", metric_name=f"m{int(maturity)}_retention_rate",
        alert_type="cohort_retention_degradation", direction="decrease", baseline_rows=6,
    )
    series = cohorts.where(F.col("months_since_acquisition") == int(maturity)).select(
        F.col("cohort_month").alias("snapshot_date"),
        F.lit(cfg.status).alias("retention_status"),
        F.col("active_customers").alias("customer_count"),
        F.col("cohort_size").alias("total_customers"),
        F.col("retention_rate").alias("status_pct"),
    )
    return alert_logic(series, cfg)


def single_day_alert(snapshot: DataFrame, reference_date, cfg: AlertConfig = AlertConfig()) -> DataFrame:
    """The literal single-date form: the distribution of one snapshot has
    one row per status, so the baseline is always NULL -> INFO, FALSE."""
    from cohortwise.functions.dates import date_lit
    from cohortwise.operators.history import snapshot_distribution

    snap = snapshot.withColumn("snapshot_date", date_lit(reference_date))
    return alert_logic(snapshot_distribution(snap), cfg)


def suppress_campaigns(alerts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """X12 — alerts on days inside a known campaign window keep their row
    but lose the flag (``suppressed = TRUE``). Campaign windows
    (``start_date, end_date``) are expanded to days — rows = configured
    campaign days — and matched by an equi-join on the date."""
    days = campaigns.select(
        F.explode(F.sequence(F.col("start_date"), F.col("end_date"), F.expr("INTERVAL 1 DAY"))).alias("_d")
    ).distinct().withColumn("_c", F.lit(True))
    j = alerts.join(days, alerts["alert_date"] == days["_d"], "left")
    sup = F.coalesce(F.col("_c"), F.lit(False))
    cols = [c for c in alerts.columns if c != "alert_flag"]
    return j.select(*cols, (F.col("alert_flag") & ~sup).alias("alert_flag"), sup.alias("suppressed"))


# ---------------------------------------------------------------------------
# Severity routing (WARNING -> monitoring channel,
# CRITICAL -> executive channel and e-mail).
# ---------------------------------------------------------------------------
ROUTES = {
    WARNING: ["retention-monitoring"],
    CRITICAL: ["executive-alerts", "email"],
}


def route_alerts(alerts: DataFrame, routes: dict[str, list[str]] = ROUTES) -> DataFrame:
    """X19 / SNK4 — the outbox: one row per (flagged alert, destination)."""
    m = F.create_map(*[x for sev, dests in routes.items() for x in (F.lit(sev), F.array(*[F.lit(d) for d in dests]))])
    flagged = alerts.where(F.col("alert_flag"))
    return flagged.select("*", F.explode(F.element_at(m, F.col("severity"))).alias("destination"))
