"""The daily refresh as a user runs it: materialize the layers for one
reference date (facts, snapshot, risk, distribution, alert, outbox), keep the
snapshot history, alert from the stored series.

Layers read what the previous layer wrote: the alert reads metrics and never
recomputes them. Every write is idempotent for its date. ``daily_refresh``
builds the facts from all orders, as of any date; ``daily_incremental`` merges
the day's new orders into the stored profile instead. Missing snapshot days
can be backfilled in one pass with the interval join instead of one facts run
per day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.config import AlertConfig, RiskWeights, StatusThresholds
from cohortwise.operators import alerts as AL
from cohortwise.operators import history as HI
from cohortwise.operators import risk as RK
from cohortwise.operators import runs as RU
from cohortwise.operators import status as ST
from cohortwise.operators.profile import customer_profile, facts_from_profile
from cohortwise.sources import tables as T
from cohortwise.sources.publication import Publication
from cohortwise.streaming.incremental import merge_profile_epoch
from cohortwise.streaming.versions import VersionedTable


def _d(x) -> _dt.date:
    return _dt.date.fromisoformat(x) if isinstance(x, str) else x


def backfill_snapshots(spark: SparkSession, orders: DataFrame, root: str, start, end,
                       thresholds: StatusThresholds = StatusThresholds()) -> None:
    """Write customer-level snapshots for every day of [start, end] in one
    pass: status runs listed under their days."""
    runs = RU.status_runs(HI.order_day_intervals(orders, end), thresholds)
    T.write_snapshot(RU.daily_snapshots(runs, start, end), f"{root}/snapshots")


def backfill_distribution(spark: SparkSession, orders: DataFrame, root: str, start, end,
                          thresholds: StatusThresholds = StatusThresholds()) -> None:
    """Write the daily status distribution for [start, end] from the delta
    history (no customer-level rows at all)."""
    T.write_distribution(HI.status_history(orders, start, end, thresholds), f"{root}/distribution")


def monthly_cohorts(spark: SparkSession, root: str, max_months: int | None = None) -> DataFrame:
    """The monthly layer from the stored profile (no pass over orders)."""
    from cohortwise.operators.cohorts import cohort_retention
    from cohortwise.operators.profile import customer_months_from_profile

    cohorts = cohort_retention(None, max_months, months=customer_months_from_profile(
        T.read_facts(spark, f"{root}/facts")))
    T.write_cohorts(cohorts, f"{root}/cohorts")
    return cohorts


def daily_refresh(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    reference_date,
    root: str,
    thresholds: StatusThresholds = StatusThresholds(),
    weights: RiskWeights = RiskWeights(),
    alert: AlertConfig = AlertConfig(),
    keep_days: int = 90,
) -> DataFrame:
    """One day: facts as of the date (via the customer profile), then the
    layers on top. Returns the day's alert row(s)."""
    ref = _d(reference_date)
    T.write_facts(customer_profile(orders, customers, as_of=ref), f"{root}/facts")
    facts = facts_from_profile(T.read_facts(spark, f"{root}/facts"))
    return _layers(spark, facts, ref, root, thresholds, weights, alert, keep_days)


def daily_incremental(
    spark: SparkSession,
    new_orders: DataFrame,
    customers: DataFrame,
    reference_date,
    root: str,
    thresholds: StatusThresholds = StatusThresholds(),
    weights: RiskWeights = RiskWeights(),
    alert: AlertConfig = AlertConfig(),
    keep_days: int = 90,
) -> DataFrame:
    """One day without reading the order history: ``new_orders``, the rows
    that arrived since the day before (late ones included), are merged into
    the stored profile under ``<root>/profile``; the rest as in
    ``daily_refresh``. The day's number is the merge's epoch, so the newest
    day can be run again; an older one needs ``daily_refresh``. Attributes of
    a customer are those of the last merge that touched them."""
    ref = _d(reference_date)
    table, epoch = f"{root}/profile", ref.toordinal()
    merge_profile_epoch(spark, table, epoch, new_orders, customers)
    profile = spark.read.parquet(*VersionedTable(spark, table).newest("profile", before=epoch + 1))
    return _layers(spark, facts_from_profile(profile), ref, root, thresholds, weights, alert, keep_days)


def publish_day(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    reference_date,
    root: str,
    thresholds: StatusThresholds = StatusThresholds(),
    weights: RiskWeights = RiskWeights(),
    alert: AlertConfig = AlertConfig(),
    keep_days: int = 90,
    fail_after: str | None = None,
) -> DataFrame:
    """One day as a whole: profile, snapshot, risk, distribution and outbox of
    the date are written and then published together, so readers of
    ``Publication(spark, root)`` see either all layers of the day or none. A
    day run again replaces its parts. ``fail_after`` names a layer after which
    the run breaks off, for tests of recovery. Returns the day's alert row(s)."""
    ref = _d(reference_date)
    day, run = ref.isoformat(), Publication(spark, root).begin()

    def write(df: DataFrame, layer: str, part: str = "") -> DataFrame:
        stored = run.write(df, layer, part)
        if fail_after == layer:
            raise RuntimeError(f"broken off after {layer}")
        return stored

    facts = facts_from_profile(write(customer_profile(orders, customers, as_of=ref), "profile"))
    today = write(ST.retention_status(facts, ref, thresholds), "snapshots", day)
    write(RK.churn_detection(facts, ref, thresholds, weights, snapshot=today).withColumn("snapshot_date", F.lit(ref)), "risk", day)
    write(HI.snapshot_distribution(today), "distribution", day)
    oldest = (ref - _dt.timedelta(days=keep_days)).isoformat()
    for layer in ("snapshots", "risk"):
        run.keep(layer, oldest)
    series = run.read("distribution").where(F.col("snapshot_date").between(F.lit(oldest).cast("date"), F.lit(ref)))
    alerts = write(AL.alert_logic(series, alert).where(F.col("alert_date") == F.lit(ref)), "alerts", day)
    write(AL.route_alerts(alerts), "outbox", day)
    run.publish()
    return alerts


def _layers(spark: SparkSession, facts: DataFrame, ref: _dt.date, root: str, thresholds: StatusThresholds,
            weights: RiskWeights, alert: AlertConfig, keep_days: int) -> DataFrame:
    """Snapshot and risk of the day (replacing an earlier run of it),
    retention policy, the day's distribution, the alert for the date from the
    stored distribution series, routed outbox."""
    T.write_snapshot(ST.retention_status(facts, ref, thresholds), f"{root}/snapshots")
    today = T.read_snapshot(spark, f"{root}/snapshots", ref, ref)
    risk = RK.churn_detection(facts, ref, thresholds, weights, snapshot=today)
    T.write_snapshot(risk.withColumn("snapshot_date", F.lit(ref)), f"{root}/risk")
    for name in ("snapshots", "risk"):
        T.keep_recent(spark, f"{root}/{name}", ref, keep_days)
    # the day's distribution (a few rows) is stored; the alert reads that
    # small series, never the customer-level snapshots of past days
    T.write_distribution(HI.snapshot_distribution(today), f"{root}/distribution")
    series = spark.read.parquet(f"{root}/distribution").where(
        F.col("snapshot_date").between(F.lit(ref - _dt.timedelta(days=keep_days)), F.lit(ref)))
    alerts = AL.alert_logic(series, alert).where(F.col("alert_date") == F.lit(ref))
    T.write_outbox(AL.route_alerts(alerts), f"{root}/outbox", days=[ref])
    return alerts
