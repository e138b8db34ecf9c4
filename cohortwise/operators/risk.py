"""Layer 3 — explainable churn risk (rule signals, weighted sum, three levels).

When the status is derived from the same facts (the usual case) the
facts-to-snapshot inner join is a 1:1 self join on the key; it is replaced
by columns on the same row (only the inner join's NULL-key removal is
kept). A stored snapshot can still be passed and is then joined on
``customer_id``.

Signal comparisons use exact integer cross-multiplication (see
``functions.numeric.exceeds_gap_multiple``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.config import ACTIVE, HIGH, LOW, MEDIUM, RiskWeights, StatusThresholds
from cohortwise.functions.dates import date_lit, day_diff, month_diff
from cohortwise.functions.numeric import exceeds_gap_multiple
from cohortwise.operators.status import status_expr

RISK_COLUMNS = [
    "customer_id",
    "retention_status",
    "days_since_last_order",
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "is_frequency_drop",
    "is_value_drop",
    "is_status_inconsistent",
    "churn_risk_score",
    "churn_risk_level",
]

_WEIGHT_FIELDS = {
    "w_frequency": "frequency_drop",
    "w_value": "value_drop",
    "w_inconsistent": "status_inconsistent",
    "w_engagement": "engagement",
    "high_min": "high_min",
    "medium_min": "medium_min",
    "frequency_factor_pct": "frequency_factor_pct",
    "inconsistency_factor_pct": "inconsistency_factor_pct",
    "value_factor_pct": "value_factor_pct",
    "low_orders_max": "low_orders_max",
}


def _weights_as_columns(df: DataFrame, weights: RiskWeights, weights_df: DataFrame | None,
                        segment_col: str) -> DataFrame:
    """Attach the weight parameters as columns: literals from ``weights``,
    overridden per segment by ``weights_df`` (one row per configured
    segment)."""
    if weights_df is None:
        return df.select("*", *[F.lit(int(getattr(weights, f))).alias(c) for c, f in _WEIGHT_FIELDS.items()])
    cfg = weights_df.select(
        F.col("customer_segment").alias("_seg"),
        *[F.col(c).cast("int").alias("_" + c) for c in _WEIGHT_FIELDS if c in weights_df.columns],
    )
    j = df.join(cfg, df[segment_col].eqNullSafe(cfg["_seg"]), "left")
    cols = []
    for c, f in _WEIGHT_FIELDS.items():
        default = F.lit(int(getattr(weights, f)))
        cols.append((F.coalesce(F.col("_" + c), default) if ("_" + c) in cfg.columns else default).alias(c))
    return j.select(*df.columns, *cols)


def customer_behavior(
    facts: DataFrame,
    reference_date=None,
    thresholds: StatusThresholds = StatusThresholds(),
    snapshot: DataFrame | None = None,
) -> DataFrame:
    """C1 — facts with recency, status and behaviour ratios on one row."""
    if snapshot is None:
        ref = date_lit(reference_date)
        days = day_diff("last_order_date", ref)
        base = facts.where(F.col("customer_id").isNotNull()).select(
            "*",
            days.alias("days_since_last_order"),
            status_expr(days, thresholds.active_days, thresholds.at_risk_days).alias("retention_status"),
        )
    else:
        # the join is 1:1 only on one snapshot date: cut a multi-day table first
        if reference_date is not None and "snapshot_date" in snapshot.columns:
            snapshot = snapshot.where(F.col("snapshot_date") == date_lit(reference_date))
        snap = snapshot.select("customer_id", "days_since_last_order", "retention_status")
        base = facts.join(snap, "customer_id", "inner")
    life = day_diff("first_order_date", "last_order_date")
    months = month_diff("first_order_date", "last_order_date")
    n = F.col("total_orders")
    return base.select(
        "*",
        life.alias("customer_lifetime_days"),
        F.when(n > 1, life.cast("double") / (n - 1).cast("double")).alias("avg_days_between_orders"),
        F.when(months > 0, n.cast("double") / months.cast("double"))
        .otherwise(n.cast("double"))
        .alias("orders_per_month_active"),
    )


def churn_signals(behavior: DataFrame, engagement: DataFrame | None = None,
                  engagement_min_events: int = 1) -> DataFrame:
    """C2 — boolean signals. Expects weight columns (see ``_weights_as_columns``)."""
    d, n, life = F.col("days_since_last_order"), F.col("total_orders"), F.col("customer_lifetime_days")
    freq = exceeds_gap_multiple(d, life, n, F.col("frequency_factor_pct"))
    near = exceeds_gap_multiple(d, life, n, F.col("inconsistency_factor_pct"))
    incons = F.coalesce(
        (F.col("retention_status") == F.lit(ACTIVE)) & ((n <= F.col("low_orders_max")) | near),
        F.lit(False),
    )
    if "last_order_value" in behavior.columns:
        value = F.coalesce(
            F.col("last_order_value") * 100.0 < F.col("avg_order_value") * F.col("value_factor_pct").cast("double"),
            F.lit(False),
        )
    else:
        value = F.lit(False)
    out = behavior.select(
        "*",
        freq.alias("is_frequency_drop"),
        value.alias("is_value_drop"),
        incons.alias("is_status_inconsistent"),
    )
    if engagement is not None:
        out = out.join(engagement.select("customer_id", "engagement_events"), "customer_id", "left")
        out = out.withColumn("engagement_events", F.coalesce("engagement_events", F.lit(0)).cast("long"))
        out = out.withColumn("is_low_engagement", F.col("engagement_events") < F.lit(int(engagement_min_events)))
    return out


def score_expr(has_engagement: bool = False) -> Column:
    """C3 — weighted sum of fired signals."""
    s = (
        F.when(F.col("is_frequency_drop"), F.col("w_frequency")).otherwise(0)
        + F.when(F.col("is_value_drop"), F.col("w_value")).otherwise(0)
        + F.when(F.col("is_status_inconsistent"), F.col("w_inconsistent")).otherwise(0)
    )
    if has_engagement:
        s = s + F.when(F.col("is_low_engagement"), F.col("w_engagement")).otherwise(0)
    return s.cast("int")


def level_expr(score: Column) -> Column:
    """C4 — HIGH from ``high_min``, MEDIUM from ``medium_min``, else LOW."""
    return (
        F.when(score >= F.col("high_min"), F.lit(HIGH))
        .when(score >= F.col("medium_min"), F.lit(MEDIUM))
        .otherwise(F.lit(LOW))
    )


def churn_detection(
    facts: DataFrame,
    reference_date=None,
    thresholds: StatusThresholds = StatusThresholds(),
    weights: RiskWeights = RiskWeights(),
    snapshot: DataFrame | None = None,
    weights_df: DataFrame | None = None,
    segment_col: str = "customer_segment",
    engagement: DataFrame | None = None,
    engagement_min_events: int = 1,
    diagnostics: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """C1-C5 — one row per customer with signals, score and level (and the
    fact columns named in ``keep``).

    ``weights.value_drop_enabled`` needs facts built with
    ``with_last_order_value=True``; otherwise the value signal is the
    reference's constant FALSE."""
    f = facts
    if not weights.value_drop_enabled and "last_order_value" in f.columns:
        f = f.drop("last_order_value")
    beh = customer_behavior(f, reference_date, thresholds, snapshot)
    beh = _weights_as_columns(beh, weights, weights_df, segment_col)
    sig = churn_signals(beh, engagement, engagement_min_events)
    score = score_expr(engagement is not None)
    out = sig.select("*", score.alias("churn_risk_score")).withColumn(
        "churn_risk_level", level_expr(F.col("churn_risk_score"))
    )
    cols = list(RISK_COLUMNS)
    if engagement is not None:
        cols[9:9] = ["engagement_events", "is_low_engagement"]
    if diagnostics:
        cols += ["customer_lifetime_days", "avg_days_between_orders", "orders_per_month_active"]
    return out.select(*cols, *(keep or []))


def engagement_counts(events: DataFrame, reference_date, window_days: int = 30) -> DataFrame:
    """X26 — non-purchase events per customer in the ``window_days`` days up
    to and including the reference date (partial aggregation, one row per
    active customer)."""
    ref = date_lit(reference_date)
    w = events.where(
        (F.col("event_date") <= ref) & (F.col("event_date") > F.date_sub(ref, int(window_days)))
    )
    return w.groupBy("customer_id").agg(F.count(F.lit(1)).alias("engagement_events"))
