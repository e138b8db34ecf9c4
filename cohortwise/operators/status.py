"""Layer 2 — retention status of every customer at a reference date.

A narrow projection over the facts (no shuffle). Several threshold sets
(A/B comparison) ride along as one array column, built from literals or read
once from a configuration table, and are exploded: per customer, or for the
distribution on a histogram of recency values, so the customer table is
scanned once whatever the number of sets, and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.config import (
    ACTIVE,
    AT_RISK,
    DATA_QUALITY_ISSUE,
    INACTIVE,
    StatusThresholds,
)
from cohortwise.functions.dates import date_lit, day_diff
from cohortwise.functions.literals import literal_rows, literal_table

STATUS_COLUMNS = [
    "customer_id",
    "last_order_date",
    "days_since_last_order",
    "retention_status",
    "snapshot_date",
]


def status_expr(days, active_days, at_risk_days) -> Column:
    """R3 — first match wins; the future guard is tested first and a NULL
    recency falls through to INACTIVE."""
    d = F.col(days) if isinstance(days, str) else days
    a = active_days if isinstance(active_days, Column) else F.lit(int(active_days))
    b = at_risk_days if isinstance(at_risk_days, Column) else F.lit(int(at_risk_days))
    return (
        F.when(d < 0, F.lit(DATA_QUALITY_ISSUE))
        .when(d <= a, F.lit(ACTIVE))
        .when(d <= b, F.lit(AT_RISK))
        .otherwise(F.lit(INACTIVE))
    )


def retention_status(
    facts: DataFrame,
    reference_date,
    thresholds: StatusThresholds = StatusThresholds(),
    keep: list[str] | None = None,
) -> DataFrame:
    """R1-R4 — ``customer_id, last_order_date, days_since_last_order,
    retention_status, snapshot_date`` (+ any ``keep`` fact columns)."""
    ref = date_lit(reference_date)
    days = day_diff("last_order_date", ref)
    return facts.select(
        "customer_id",
        "last_order_date",
        days.alias("days_since_last_order"),
        status_expr(days, thresholds.active_days, thresholds.at_risk_days).alias("retention_status"),
        ref.alias("snapshot_date"),
        *(keep or []),
    )


def threshold_sets_df(spark: SparkSession, sets: list[StatusThresholds]) -> DataFrame:
    """U1 / SRC5 — configured threshold sets as a DataFrame (one row per set)."""
    rows = [(s.name, int(s.active_days), int(s.at_risk_days)) for s in sets]
    return literal_table(spark, rows, "threshold_set string, active_days int, at_risk_days int")


def active_thresholds(config: DataFrame) -> DataFrame:
    """SRC5 — the active row(s) of a threshold configuration table
    (``threshold_set, active_days, at_risk_days, active``)."""
    return config.where(F.col("active")).select("threshold_set", "active_days", "at_risk_days")


def _with_sets(df: DataFrame, sets: DataFrame | list[StatusThresholds]) -> DataFrame:
    """Every row once per configured set: given as a list, the sets are one
    literal array; a configuration table is read as one value. Exploded."""
    if isinstance(sets, DataFrame):
        entries = sets.agg(F.collect_list(F.struct("threshold_set", "active_days", "at_risk_days")).alias("s")).scalar()
    else:
        entries = literal_rows([(s.name, int(s.active_days), int(s.at_risk_days)) for s in sets],
                               "threshold_set string, active_days int, at_risk_days int")
    return df.select(*df.columns, F.explode(entries).alias("_set")).select(*df.columns, "_set.*")


def status_by_threshold_sets(facts: DataFrame, reference_date, sets_df: DataFrame | list[StatusThresholds]) -> DataFrame:
    """X13 per customer — status under every configured set."""
    ref = date_lit(reference_date)
    base = facts.select("customer_id", "last_order_date", day_diff("last_order_date", ref).alias("d"))
    return _with_sets(base, sets_df).select(
        "threshold_set",
        "customer_id",
        "last_order_date",
        F.col("d").alias("days_since_last_order"),
        status_expr("d", F.col("active_days"), F.col("at_risk_days")).alias("retention_status"),
    )


def threshold_set_distribution(facts: DataFrame, reference_date, sets_df: DataFrame | list[StatusThresholds]) -> DataFrame:
    """X13 distribution — customers per status under every set, from one
    pass over the facts: a histogram of recency values (at most one row per
    distinct day count) is taken under every set and re-aggregated."""
    ref = date_lit(reference_date)
    hist = (
        facts.select(day_diff("last_order_date", ref).alias("d"))
        .groupBy("d")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    j = _with_sets(hist, sets_df).select(
        "threshold_set",
        status_expr("d", F.col("active_days"), F.col("at_risk_days")).alias("retention_status"),
        "n",
    )
    out = j.groupBy("threshold_set", "retention_status").agg(F.sum("n").cast("long").alias("customer_count"))
    from pyspark.sql.window import Window

    w = Window.partitionBy("threshold_set")
    return out.withColumn(
        "pct",
        F.round(F.col("customer_count").cast("double") * 100.0 / F.sum("customer_count").over(w).cast("double"), 1),
    )
