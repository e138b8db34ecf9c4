"""Quality checks: each returns a DataFrame of violations or a summary.

All checks are aggregations with partial (map-side) aggregation; the only
windows run over the handful of rows of a distribution (one partition of at
most a few rows per status / level), never over customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.functions.literals import literal_table
from cohortwise.config import STATUSES, LEVELS


def _share(count_col: str, partition: list[str] | None = None, digits: int = 1):
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return F.round(F.col(count_col).cast("double") * 100.0 / F.sum(count_col).over(w).cast("double"), digits)


def _rank(col: str, values) -> F.Column:
    expr = None
    for i, v in enumerate(values, start=1):
        expr = (F.when(F.col(col) == v, i) if expr is None else expr.when(F.col(col) == v, i))
    return expr.otherwise(len(values) + 1)


def status_distribution(snapshot: DataFrame) -> DataFrame:
    """Q4 — customers per status with share (1 decimal), ordered by status rank."""
    g = snapshot.groupBy("retention_status").agg(F.count(F.lit(1)).alias("customer_count"))
    return g.withColumn("pct", _share("customer_count")).orderBy(_rank("retention_status", STATUSES))


def risk_distribution(risk: DataFrame) -> DataFrame:
    """Q8 — customers per risk level with share."""
    g = risk.groupBy("churn_risk_level").agg(F.count(F.lit(1)).alias("customer_count"))
    return g.withColumn("pct", _share("customer_count")).orderBy(_rank("churn_risk_level", LEVELS))


# ---------------------------------------------------------------------------
# Layer 1 checks
# ---------------------------------------------------------------------------


def facts_summary(facts: DataFrame) -> DataFrame:
    """Q1 — one row: size, uniqueness, date span, averages, violation counters
    (plus the NULL-key row count, which GROUP BY keeps as a customer)."""
    # fixed values: the names of the check's columns
    return facts.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("first_order_date").alias("earliest_customer"),
        F.max("last_order_date").alias("most_recent_order"),
        F.avg("total_orders").alias("avg_orders_per_customer"),
        F.avg("total_revenue").alias("avg_revenue_per_customer"),
        F.count_if(F.col("first_order_date") > F.col("last_order_date")).alias("invalid_date_order"),
        F.count_if(F.col("total_revenue") < 0).alias("negative_revenue"),
        F.count_if(F.col("total_orders") <= 0).alias("zero_orders"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
    )


def duplicate_customers(facts: DataFrame) -> DataFrame:
    """Q2 — customers appearing more than once (expected: none)."""
    return facts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def negative_facts(facts: DataFrame) -> DataFrame:
    """Q3 — negative order counts or revenue (expected: none)."""
    return facts.where((F.col("total_orders") < 0) | (F.col("total_revenue") < 0))


# ---------------------------------------------------------------------------
# Layer 2 checks
# ---------------------------------------------------------------------------


def snapshot_validation(snapshot: DataFrame) -> DataFrame:
    """Q5 — recency span, uniqueness and future orders in one row."""
    return snapshot.agg(
        F.min("days_since_last_order").alias("min_days"),
        F.max("days_since_last_order").alias("max_days"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("days_since_last_order") < 0).alias("future_orders"),
    )


def threshold_ranges(snapshot: DataFrame) -> DataFrame:
    """Q6 — recency range per status (ACTIVE 0..a, AT_RISK a+1..b, ...)."""
    return snapshot.groupBy("retention_status").agg(
        F.min("days_since_last_order").alias("min_days"), F.max("days_since_last_order").alias("max_days")
    )


def multi_status_customers(snapshot: DataFrame) -> DataFrame:
    """Q7 — customers with more than one status on one date (expected: none)."""
    return (
        snapshot.groupBy("customer_id", "snapshot_date")
        .agg(F.count_distinct("retention_status").alias("status_count"))
        .where(F.col("status_count") > 1)
    )


# ---------------------------------------------------------------------------
# Layer 3 checks
# ---------------------------------------------------------------------------


def status_level_crosstab(risk: DataFrame) -> DataFrame:
    """Q9 — customers per (status, level) with share within the status."""
    g = risk.groupBy("retention_status", "churn_risk_level").agg(F.count(F.lit(1)).alias("customer_count"))
    return g.withColumn("pct_within_status", _share("customer_count", ["retention_status"])).orderBy(
        "retention_status", "churn_risk_level"
    )


def signal_combinations(risk: DataFrame) -> DataFrame:
    """Q10 — how often each combination of signals fires."""
    return (
        risk.groupBy("is_frequency_drop", "is_value_drop", "is_status_inconsistent")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy(F.desc("customer_count"))
    )


def score_out_of_range(risk: DataFrame) -> DataFrame:
    """Q11 — scores outside 0..100 (expected: none)."""
    return risk.where((F.col("churn_risk_score") < 0) | (F.col("churn_risk_score") > 100))


def model_adds_value(risk: DataFrame) -> DataFrame:
    """Q21 — the failure condition "every INACTIVE is HIGH and every ACTIVE
    is LOW" (the score would only repeat the status)."""
    from cohortwise.config import ACTIVE, HIGH, INACTIVE, LOW

    st, lv = F.col("retention_status"), F.col("churn_risk_level")
    all_inactive_high = F.coalesce(F.bool_and(F.when(st == INACTIVE, lv == HIGH)), F.lit(True))
    all_active_low = F.coalesce(F.bool_and(F.when(st == ACTIVE, lv == LOW)), F.lit(True))
    out = risk.agg(all_inactive_high.alias("all_inactive_high"), all_active_low.alias("all_active_low"))
    return out.withColumn("model_fails", F.col("all_inactive_high") & F.col("all_active_low"))


# ---------------------------------------------------------------------------
# Layer 4 checks
# ---------------------------------------------------------------------------


def cohort_size_consistency(cohorts: DataFrame) -> DataFrame:
    """Q12 — one row per (cohort, size) with the maturities tracked; more
    than one row for a cohort means its size varies (logic error)."""
    return cohorts.groupBy("cohort_month", "cohort_size").agg(
        F.count_distinct("months_since_acquisition").alias("maturity_months_tracked")
    ).orderBy("cohort_month")


def rate_out_of_range(cohorts: DataFrame) -> DataFrame:
    """Q13 — retention rates outside 0..100 (expected: none)."""
    return cohorts.where((F.col("retention_rate") > 100) | (F.col("retention_rate") < 0)).select(
        "cohort_month", "months_since_acquisition", "retention_rate", "active_customers", "cohort_size"
    )


def m0_below(cohorts: DataFrame, floor: float = 95.0) -> DataFrame:
    """Q14 — cohorts whose M+0 rate is below ``floor`` (expected: none)."""
    return cohorts.where((F.col("months_since_acquisition") == 0) & (F.col("retention_rate") < floor)).select(
        "cohort_month", "months_since_acquisition", "retention_rate"
    )


def cohort_progression(cohorts: DataFrame) -> DataFrame:
    """Q15 — retention drop (max - min rate) and oldest maturity per cohort."""
    return cohorts.groupBy("cohort_month").agg(
        F.round(F.max("retention_rate") - F.min("retention_rate"), 2).alias("retention_drop"),
        F.max("months_since_acquisition").alias("max_maturity_tracked"),
    ).orderBy("cohort_month")


def at_maturity(cohorts: DataFrame, months: int = 3) -> DataFrame:
    """Q16 — every cohort at the same maturity (``months``), by cohort."""
    return cohorts.where(F.col("months_since_acquisition") == int(months)).select(
        "months_since_acquisition", "cohort_month", "retention_rate"
    ).orderBy("cohort_month")


def for_cohort(cohorts: DataFrame, cohort_month) -> DataFrame:
    """One cohort's curve over maturities."""
    from cohortwise.functions.dates import date_lit

    return cohorts.where(F.col("cohort_month") == date_lit(cohort_month)).orderBy("months_since_acquisition")


# ---------------------------------------------------------------------------
# Layer 5 checks
# ---------------------------------------------------------------------------


def alert_frequency(alerts: DataFrame, reference_date, days: int = 30, until=None) -> DataFrame:
    """Q17 — alerts per severity from ``days`` days before the reference date
    on; without ``until`` the window has no end."""
    from cohortwise.functions.dates import date_lit

    ref = date_lit(reference_date)
    window = alerts.where(F.col("alert_date") >= F.date_sub(ref, int(days)))
    if until is not None:
        window = window.where(F.col("alert_date") <= date_lit(until))
    return (
        window.groupBy("severity")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.count_if(F.col("alert_flag")).alias("triggered_count"),
            F.round(F.avg("delta_relative_pct"), 2).alias("avg_delta_pct"),
        )
    )


def missing_baseline(alerts: DataFrame, after=None) -> DataFrame:
    """Q18 — evaluations without a baseline (expected only in the warm-up);
    ``after`` restricts to dates after the warm-up."""
    from cohortwise.functions.dates import date_lit

    a = alerts.where(F.col("baseline_value").isNull())
    if after is not None:
        a = a.where(F.col("alert_date") > date_lit(after))
    return a.select(
        "alert_date", "baseline_value", "current_value",
        F.abs(F.col("current_value") - F.col("baseline_value")).alias("deviation"),
    )


def baseline_deviation(alerts: DataFrame, min_points: float = 5.0) -> DataFrame:
    """Q18's deviation where there is a baseline: evaluations whose value lies
    at least ``min_points`` percentage points from it, on either side."""
    out = alerts.select("alert_date", "baseline_value", "current_value",
                        F.abs(F.col("current_value") - F.col("baseline_value")).alias("deviation"))
    return out.where(F.col("deviation") >= F.lit(float(min_points)))


def sample_size_spread(alerts: DataFrame) -> DataFrame:
    """Q19 — min / mean / max evaluated population."""
    return alerts.agg(
        F.min("sample_size").alias("min_sample"),
        F.avg("sample_size").alias("avg_sample"),
        F.max("sample_size").alias("max_sample"),
    )


# ---------------------------------------------------------------------------
# Q20 — health bands and red flags as rules.
# The indicative e-commerce bands and red-flag limits (percent).
# ---------------------------------------------------------------------------
STATUS_BANDS = [
    ("ACTIVE", 20.0, 40.0),
    ("AT_RISK", 15.0, 25.0),
    ("INACTIVE", 40.0, 60.0),
    ("DATA_QUALITY_ISSUE", 0.0, 0.0),
]
RISK_BANDS = [
    ("HIGH", 5.0, 15.0),
    ("MEDIUM", 15.0, 30.0),
    ("LOW", 55.0, 80.0),
]
ALERT_MONTHLY_BANDS = [
    ("CRITICAL", 0.0, 2.0),
    ("WARNING", 2.0, 5.0),
]


def band_verdicts(distribution: DataFrame, label_col: str, value_col: str, bands) -> DataFrame:
    """Every band's verdict, OK or OUT_OF_BAND; a label the distribution
    lacks has the value 0. Labels without a band: NO_BAND."""
    spark = distribution.sparkSession
    rules = literal_table(spark, [(a, float(lo), float(hi)) for a, lo, hi in bands],
                          "_label string, band_min double, band_max double")
    j = rules.join(distribution, distribution[label_col] == rules["_label"], "full")
    j = j.select(F.coalesce(label_col, "_label").alias(label_col), "band_min", "band_max",
                 F.coalesce(F.col(value_col), F.lit(0).cast(distribution.schema[value_col].dataType)).alias(value_col))
    v = F.col(value_col)
    verdict = (
        F.when(F.col("band_min").isNull(), F.lit("NO_BAND"))
        .when((v >= F.col("band_min")) & (v <= F.col("band_max")), F.lit("OK"))
        .otherwise(F.lit("OUT_OF_BAND"))
    )
    return j.select(label_col, value_col, "band_min", "band_max", verdict.alias("verdict"))


def status_red_flags(distribution: DataFrame) -> DataFrame:
    """Red flags of a status distribution (``retention_status, pct``) as one
    row: ACTIVE < 10 %, INACTIVE > 70 %, AT_RISK > ACTIVE or > 30 %, any DQ."""
    def share(s):
        return F.coalesce(F.max(F.when(F.col("retention_status") == s, F.col("pct"))), F.lit(0.0))

    one = distribution.agg(
        share("ACTIVE").alias("active_pct"),
        share("AT_RISK").alias("at_risk_pct"),
        share("INACTIVE").alias("inactive_pct"),
        share("DATA_QUALITY_ISSUE").alias("dq_pct"),
    )
    return one.select(
        "*",
        (F.col("active_pct") < 10).alias("flag_active_below_10"),
        (F.col("inactive_pct") > 70).alias("flag_inactive_above_70"),
        (F.col("at_risk_pct") > F.col("active_pct")).alias("flag_at_risk_above_active"),
        (F.col("at_risk_pct") > 30).alias("flag_at_risk_above_30"),
        (F.col("dq_pct") > 0).alias("flag_data_quality"),
    )


def signal_red_flag(risk: DataFrame) -> DataFrame:
    """Share of customers for whom no signal fires; a flag above 90 %."""
    none = ~(F.col("is_frequency_drop") | F.col("is_value_drop") | F.col("is_status_inconsistent"))
    one = risk.agg(F.round(F.count_if(none).cast("double") * 100.0 / F.count(F.lit(1)).cast("double"), 1).alias("no_signal_pct"))
    return one.select("no_signal_pct", (F.col("no_signal_pct") > 90).alias("flag_no_signal_above_90"))


def alert_red_flags(alerts: DataFrame) -> DataFrame:
    """Per month with alert rows: triggered CRITICAL and WARNING alerts, a
    flag for more than 5 CRITICAL, and one when neither this nor the two
    calendar months before had a WARNING. The series has one row a month."""
    triggered = F.col("alert_flag")
    months = alerts.groupBy(F.trunc("alert_date", "month").alias("month")).agg(
        F.count_if(triggered & (F.col("severity") == "CRITICAL")).alias("critical_count"),
        F.count_if(triggered & (F.col("severity") == "WARNING")).alias("warning_count"))
    number = F.year("month") * 12 + F.month("month")
    last_three = Window.partitionBy().orderBy(number).rangeBetween(-2, 0)
    return months.select(
        "month", "critical_count", "warning_count", (F.col("critical_count") > 5).alias("flag_critical_above_5"),
        ((F.sum("warning_count").over(last_three) == 0) & (F.count(F.lit(1)).over(last_three) == 3))
        .alias("flag_no_warning_three_months"))


def risk_red_flags(distribution: DataFrame) -> DataFrame:
    """Red flags of a risk distribution (``churn_risk_level, pct``): HIGH > 25 %,
    HIGH < 5 %, LOW > 90 %."""
    def share(s):
        return F.coalesce(F.max(F.when(F.col("churn_risk_level") == s, F.col("pct"))), F.lit(0.0))

    one = distribution.agg(share("HIGH").alias("high_pct"), share("LOW").alias("low_pct"))
    return one.select(
        "*",
        (F.col("high_pct") > 25).alias("flag_high_above_25"),
        (F.col("high_pct") < 5).alias("flag_high_below_5"),
        (F.col("low_pct") > 90).alias("flag_low_above_90"),
    )
