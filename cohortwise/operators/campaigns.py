"""Operational outputs built on the layers: campaign lists, priority top-k,
status x risk action matrix, transitions between two dates, score trends,
alert drill-down, risk per cohort.

Everything is a join on ``customer_id`` (both sides hash-partitioned on
it) or a join with a configuration table whose size is the number of
configured rows. Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
a per-partition top-k followed by a merge of k rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.config import ACTIVE, HIGH, MEDIUM
from cohortwise.functions.dates import month_start
from cohortwise.functions.literals import literal_table

# ---------------------------------------------------------------------------
# Status x risk level -> action (the business-impact notes).
# Pairs not listed are MONITOR.
# ---------------------------------------------------------------------------
ACTION_MATRIX = [
    ("ACTIVE", "HIGH", "INTERVENE_NOW"),
    ("AT_RISK", "LOW", "LET_RECOVER"),
    ("INACTIVE", "HIGH", "WIN_BACK"),
    ("INACTIVE", "LOW", "DEPRIORITIZE"),
]
DEFAULT_ACTION = "MONITOR"


def hidden_risk(risk: DataFrame) -> DataFrame:
    """X15 — the campaign list: HIGH risk customers who are still ACTIVE."""
    return risk.where((F.col("churn_risk_level") == HIGH) & (F.col("retention_status") == ACTIVE))


def campaign_priority(risk: DataFrame, capacity: int) -> DataFrame:
    """O4 — HIGH first, then MEDIUM while capacity allows; within a level
    by revenue (desc), ties by ``customer_id``. ``capacity`` is the feature
    (the number of customers the campaign can reach)."""
    rank = F.when(F.col("churn_risk_level") == HIGH, 1).when(F.col("churn_risk_level") == MEDIUM, 2)
    c = risk.where(F.col("churn_risk_level").isin(HIGH, MEDIUM)).withColumn("priority", rank)
    return c.orderBy("priority", F.desc("total_revenue"), "customer_id").limit(int(capacity))


def action_matrix_df(spark: SparkSession, matrix=ACTION_MATRIX) -> DataFrame:
    return literal_table(spark, list(matrix), "retention_status string, churn_risk_level string, action string")


def apply_action_matrix(risk: DataFrame, matrix: DataFrame) -> DataFrame:
    """X16 — each customer's action from the (status, level) mapping (a
    configuration table of at most statuses x levels rows)."""
    j = risk.join(matrix, ["retention_status", "churn_risk_level"], "left")
    return j.withColumn("action", F.coalesce(F.col("action"), F.lit(DEFAULT_ACTION)))


def action_summary(actions: DataFrame) -> DataFrame:
    """X16 summary — customers and revenue per (status, level, action)."""
    return actions.groupBy("retention_status", "churn_risk_level", "action").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum("total_revenue").alias("total_revenue")
    )


def transition_matrix(before: DataFrame, after: DataFrame, col: str = "retention_status",
                      missing: str = "NOT_A_CUSTOMER") -> DataFrame:
    """X22 — customers moving between categories (status or risk level)
    from one snapshot to another. Customers present on one side only are
    counted from / to ``missing``."""
    b = before.select("customer_id", F.col(col).alias("from_value"))
    a = after.select("customer_id", F.col(col).alias("to_value"))
    j = b.join(a, "customer_id", "full")
    return j.groupBy(
        F.coalesce("from_value", F.lit(missing)).alias(f"from_{col}"),
        F.coalesce("to_value", F.lit(missing)).alias(f"to_{col}"),
    ).agg(F.count(F.lit(1)).alias("customer_count"))


def _two_days(dated: DataFrame, first, second, columns: list[str]) -> DataFrame:
    """One row per customer with the structs ``f`` and ``s``, its row on the
    first and on the second day (null without one), by one aggregation."""
    from cohortwise.functions.dates import date_lit

    row = F.struct(*columns)
    return dated.groupBy("customer_id").agg(
        F.first(F.when(F.col("snapshot_date") == date_lit(first), row), ignorenulls=True).alias("f"),
        F.first(F.when(F.col("snapshot_date") == date_lit(second), row), ignorenulls=True).alias("s"))


def transitions_between(dated: DataFrame, first, second, col: str = "retention_status",
                        missing: str = "NOT_A_CUSTOMER") -> DataFrame:
    """X22 over a dated table (one row per customer and ``snapshot_date``),
    without a join of two snapshots."""
    both = _two_days(dated.where(F.col("customer_id").isNotNull()), first, second, [col])
    return both.groupBy(
        F.coalesce(f"f.{col}", F.lit(missing)).alias(f"from_{col}"), F.coalesce(f"s.{col}", F.lit(missing)).alias(f"to_{col}"),
    ).agg(F.count(F.lit(1)).alias("customer_count"))


def score_trend_between(dated: DataFrame, first, second, min_increase: int = 20) -> DataFrame:
    """X2 over a dated risk table, without a join of two snapshots."""
    both = _two_days(dated, first, second, ["retention_status", "churn_risk_score", "churn_risk_level"]).where("s IS NOT NULL")
    change = F.col("s.churn_risk_score") - F.coalesce(F.col("f.churn_risk_score"), F.lit(0))
    return both.select(
        "customer_id", F.col("s.retention_status").alias("retention_status"), F.col("f.churn_risk_score").alias("previous_score"),
        F.col("f.churn_risk_level").alias("previous_level"), F.col("s.churn_risk_score").alias("churn_risk_score"),
        F.col("s.churn_risk_level").alias("churn_risk_level"), change.alias("score_change"),
        (change >= int(min_increase)).alias("is_significant_increase"))


def score_trend(before: DataFrame, after: DataFrame, min_increase: int = 20) -> DataFrame:
    """X2 — score change per customer between two risk snapshots; flags a
    significant week-over-week increase. Customers without an earlier
    score start from 0."""
    b = before.select("customer_id", F.col("churn_risk_score").alias("previous_score"),
                      F.col("churn_risk_level").alias("previous_level"))
    a = after.select("customer_id", "retention_status", "churn_risk_score", "churn_risk_level")
    j = a.join(b, "customer_id", "left")
    change = F.col("churn_risk_score") - F.coalesce(F.col("previous_score"), F.lit(0))
    return j.select(
        "customer_id", "retention_status", "previous_score", "previous_level", "churn_risk_score",
        "churn_risk_level", change.alias("score_change"),
        (change >= int(min_increase)).alias("is_significant_increase"),
    )


def alert_drilldown(alerts: DataFrame, orders: DataFrame | None, thresholds=None, statuses=("AT_RISK",),
                    intervals: DataFrame | None = None, by: list[str] | None = None, end=None,
                    risk: DataFrame | None = None, top: int | None = None) -> DataFrame:
    """X20 — the customers behind each flagged alert: customers of the alert's
    scope whose status on the alert date (as-of facts) is in ``statuses``,
    with revenue to date, ordered by alert date and revenue (desc).

    ``by``: the scope keys of the alerts; ``intervals`` (with revenue and
    these keys) can be shared with the history behind the alerts, else they
    are built from ``orders`` up to ``end``. ``risk``: a risk table
    (``customer_id, churn_risk_level``) whose level is added. ``top``: only so
    many customers of each alert, by revenue (see ``top_of_alerts``).

    The alerts are read as one value. Intervals that they and this share should
    be a written table, so that orders are read once."""
    from cohortwise.config import StatusThresholds
    from cohortwise.operators.history import customer_status_on_dates, order_day_intervals

    th = thresholds or StatusThresholds()
    keys = list(by or [])
    flagged = alerts.where(F.col("alert_flag")).select(F.col("alert_date").alias("snapshot_date"), *keys, "severity").distinct()
    iv = intervals if intervals is not None else order_day_intervals(orders, end, with_revenue=True)
    st = customer_status_on_dates(iv, flagged, th, by=keys)
    out = st.where(F.col("retention_status").isin(list(statuses))).select(
        F.col("snapshot_date").alias("alert_date"), *keys, "severity", "customer_id", "last_order_date",
        "days_since_last_order", "retention_status", "total_revenue",
    )
    if top is not None:
        out = top_of_alerts(out, top, keys)
    if risk is not None:
        out = out.join(risk.select("customer_id", "churn_risk_level"), "customer_id", "left").select(
            *out.columns, "churn_risk_level")
    return out.orderBy("alert_date", *keys, F.desc("total_revenue"), "customer_id")


def top_of_alerts(customers: DataFrame, k: int, by: list[str] | None = None) -> DataFrame:
    """The ``k`` customers with most revenue behind each alert (``alert_date``
    and ``by``), ties by ``customer_id``. Spark turns the rank limit into a
    limit per task before the shuffle, so at most ``k`` rows per alert and task
    move, and nothing is sorted globally. Null revenue comes last."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("alert_date", *(by or [])).orderBy(F.desc_nulls_last("total_revenue"), "customer_id")
    return customers.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= int(k)).drop("_rank")


def alert_drilldown_from_runs(alerts: DataFrame, risk_runs: DataFrame, statuses=("AT_RISK",), top: int | None = None) -> DataFrame:
    """X20 from a stored table of risk runs: the customers behind each flagged
    (global) alert with status, revenue and risk level *of the alert's day*."""
    from cohortwise.functions.dates import day_diff

    # read as one value, at most one entry per calendar day
    flagged = alerts.where(F.col("alert_flag")).agg(F.collect_set(F.struct("alert_date", "severity")).alias("flagged")).scalar()
    runs = risk_runs.where(F.col("retention_status").isin(list(statuses))).withColumn("_flagged", flagged)
    within = F.filter("_flagged", lambda a: (a["alert_date"] >= F.col("from_day")) & (
        F.col("to_day").isNull() | (a["alert_date"] < F.col("to_day"))))
    hits = runs.withColumn("_alert", F.explode(within))
    out = hits.select(
        "_alert.alert_date", "_alert.severity", "customer_id", "last_order_date",
        day_diff("last_order_date", "_alert.alert_date").alias("days_since_last_order"), "retention_status", "total_revenue",
        "churn_risk_score", "churn_risk_level")
    return out if top is None else top_of_alerts(out, top)


def targeted_conversion(targets: DataFrame, after: DataFrame, level: str = "LOW") -> DataFrame:
    """Outcome of a campaign: the exported list (``customer_id,
    churn_risk_level`` at the time) against a later risk table. One row per
    level at the time: customers targeted, back to ``level``, and the rate.
    Customers the later table lacks count as targeted and not converted."""
    later = after.select("customer_id", (F.col("churn_risk_level") == level).alias("_back"))
    j = targets.select("customer_id", F.col("churn_risk_level").alias("targeted_level")).join(later, "customer_id", "left")
    g = j.groupBy("targeted_level").agg(F.count(F.lit(1)).alias("targeted"),
                                        F.count_if(F.coalesce(F.col("_back"), F.lit(False))).alias("converted"))
    return g.withColumn("conversion_pct", F.round(F.col("converted").cast("double") * 100.0 / F.col("targeted").cast("double"), 1))


def risk_by_cohort(risk: DataFrame) -> DataFrame:
    """X27 — risk level distribution per acquisition cohort (share within
    the cohort, 1 decimal). ``risk`` carries ``first_order_date`` (see
    ``churn_detection(keep=)``), so the facts are not read again."""
    from pyspark.sql.window import Window

    j = risk.select(month_start("first_order_date").alias("cohort_month"), "churn_risk_level")
    g = j.groupBy("cohort_month", "churn_risk_level").agg(F.count(F.lit(1)).alias("customer_count"))
    w = Window.partitionBy("cohort_month")
    return g.withColumn(
        "pct_within_cohort",
        F.round(F.col("customer_count").cast("double") * 100.0 / F.sum("customer_count").over(w).cast("double"), 1),
    )


def export_customer_list(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """SNK5 — write a campaign list (``customer_id`` and context) for a CRM."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def read_customer_list(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    """An exported list read back, in the order of its own columns."""
    r = spark.read.schema(schema)
    return r.option("header", True).option("enforceSchema", False).csv(path) if fmt == "csv" else r.parquet(path)


# ---------------------------------------------------------------------------
# X28 — subscription status rules (our reading of an outlined use case).
# ---------------------------------------------------------------------------
def subscription_status(subs: DataFrame, reference_date, renewal_window_days: int = 30) -> DataFrame:
    """``subs``: customer_id, renewal_date DATE, cancelled_at DATE (NULL if
    live). CANCELLED when cancelled on or before the date; RENEWAL_DUE when
    renewal is within ``renewal_window_days``; ACTIVE otherwise."""
    from cohortwise.functions.dates import date_lit, day_diff

    ref = date_lit(reference_date)
    to_renewal = day_diff(ref, "renewal_date")
    st = (
        F.when(F.col("cancelled_at").isNotNull() & (F.col("cancelled_at") <= ref), F.lit("CANCELLED"))
        .when(to_renewal <= int(renewal_window_days), F.lit("RENEWAL_DUE"))
        .otherwise(F.lit("ACTIVE"))
    )
    return subs.select("customer_id", to_renewal.alias("days_to_renewal"), st.alias("subscription_status"))
