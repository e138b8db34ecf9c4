"""Sinks, retention policy, incremental refresh and its streaming form."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cohortwise.operators import facts as FX
from cohortwise.operators import status as ST
from cohortwise.sources import tables as T
from cohortwise.sources import testdata as src
from cohortwise.streaming.incremental import incremental_facts, read_facts_version, read_profile_version, start_facts_refresh

SF = "/root/testdata/sf0.001"


def _rows(df):
    """Rows with doubles at 6 digits (summation order differs between plans)."""
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)


def test_snapshot_write_is_idempotent_and_pruned(spark, tmp_dir):
    f = FX.base_customers(src.orders(spark, SF), src.customers(spark, SF))
    path = os.path.join(tmp_dir, "snap")
    days = ["2001-07-01", "2001-07-02", "2001-07-03"]
    for d in days:
        T.write_snapshot(ST.retention_status(f, d), path)
    T.write_snapshot(ST.retention_status(f, days[1]), path)  # rerun one day
    snap = T.read_snapshot(spark, path)
    assert snap.count() == 3 * f.count()
    one = T.read_snapshot(spark, path, "2001-07-02", "2001-07-02")
    assert one.count() == f.count()
    removed = T.keep_recent(spark, path, "2001-07-03", keep_days=1)
    assert removed == ["2001-07-01"]
    assert T.read_snapshot(spark, path).select("snapshot_date").distinct().count() == 2


def test_facts_table_roundtrip(spark, tmp_dir):
    f = FX.base_customers(src.orders(spark, SF), src.customers(spark, SF))
    path = os.path.join(tmp_dir, "facts")
    T.write_facts(f, path)
    back = T.read_facts(spark, path).select(*f.columns)
    assert _rows(back) == _rows(f)


def test_incremental_equals_full_rebuild(spark):
    o, c = src.orders(spark, SF), src.customers(spark, SF)
    prev = FX.base_customers(o, c, as_of="2000-06-30")
    new = o.where(F.col("order_date") > F.lit(dt.date(2000, 6, 30)))
    assert _rows(incremental_facts(prev, o, new, c)) == _rows(FX.base_customers(o, c))


def test_streaming_refresh_equals_batch(spark, tmp_dir):
    raw = spark.read.parquet(f"{SF}/orders.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    cut = F.col("o_orderdate") <= F.lit(dt.datetime(1999, 1, 1))
    raw.where(cut).coalesce(1).write.parquet(os.path.join(inbox, "part1"))
    schema = raw.schema

    def to_orders(df):
        return df.select(
            F.col("o_custkey").cast("long").alias("customer_id"), F.col("o_orderkey").cast("long").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderstatus").alias("order_status"))

    c = src.customers(spark, SF)
    table = os.path.join(tmp_dir, "facts")
    ckpt = os.path.join(tmp_dir, "ckpt")
    src_dir = os.path.join(inbox, "*")
    q = start_facts_refresh(spark, src_dir, schema, to_orders, c, table, ckpt)
    q.awaitTermination(300)
    raw.where(~cut).coalesce(1).write.parquet(os.path.join(inbox, "part2"))
    q = start_facts_refresh(spark, src_dir, schema, to_orders, c, table, ckpt)
    q.awaitTermination(300)
    got = read_facts_version(spark, table)
    want = FX.base_customers(to_orders(raw), c)
    assert _rows(got.select(*want.columns)) == _rows(want)


def test_outbox_export_and_subscriptions(spark, tmp_dir):
    from cohortwise.operators import alerts as AL
    from cohortwise.operators import campaigns as CP

    dist = spark.createDataFrame(
        [(dt.date(2024, 3, 1) + dt.timedelta(days=i), "AT_RISK", 200, 1000, v)
         for i, v in enumerate([20.0] * 7 + [25.0])],
        "snapshot_date date, retention_status string, customer_count long, total_customers long, status_pct double")
    routed = AL.route_alerts(AL.alert_logic(dist))
    out = os.path.join(tmp_dir, "outbox")
    T.write_outbox(routed, out)
    back = spark.read.json(out)
    assert sorted(r.destination for r in back.collect()) == ["email", "executive-alerts"]

    lst = spark.createDataFrame([(1, "HIGH"), (2, "LOW")], "customer_id long, churn_risk_level string")
    CP.export_customer_list(lst.where("churn_risk_level = 'HIGH'"), os.path.join(tmp_dir, "crm"))
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "crm")).count() == 1

    subs = spark.createDataFrame(
        [(1, dt.date(2024, 2, 1), None), (2, dt.date(2024, 6, 1), None), (3, dt.date(2024, 6, 1), dt.date(2024, 1, 5))],
        "customer_id long, renewal_date date, cancelled_at date")
    got = {r.customer_id: r.subscription_status for r in CP.subscription_status(subs, "2024-01-10").collect()}
    assert got == {1: "RENEWAL_DUE", 2: "ACTIVE", 3: "CANCELLED"}


def test_daily_refresh_backfill_and_rerun(spark, tmp_dir):
    from cohortwise.operators import history as HI
    from cohortwise.plans.daily import backfill_distribution, backfill_snapshots, daily_refresh

    o, c = src.orders(spark, SF), src.customers(spark, SF)
    root = os.path.join(tmp_dir, "lake")
    backfill_snapshots(spark, o, root, "2001-06-20", "2001-06-29")
    backfill_distribution(spark, o, root, "2001-06-20", "2001-06-29")
    for day in ("2001-06-30", "2001-07-01", "2001-06-30"):  # the last run repeats a day
        a = daily_refresh(spark, o, c, day, root, keep_days=10)
        assert a.count() == 1
    snap = T.read_snapshot(spark, os.path.join(root, "snapshots"))
    days = sorted(r[0].isoformat() for r in snap.select("snapshot_date").distinct().collect())
    assert days[0] == "2001-06-21" and days[-1] == "2001-07-01" and len(days) == 11  # kept 10 days back
    # stored snapshots equal the delta history on every kept day
    stored = {(r[0], r[1]): r[2] for r in HI.snapshot_distribution(snap).select(
        "snapshot_date", "retention_status", "customer_count").collect()}
    hist = HI.status_history(o, "2001-06-21", "2001-07-01")
    want = {(r.snapshot_date, r.retention_status): r.customer_count for r in hist.collect()}
    assert stored == want
    dist = spark.read.parquet(os.path.join(root, "distribution")).where("snapshot_date >= '2001-06-21'")
    assert {(r.snapshot_date, r.retention_status): r.customer_count for r in dist.collect()} == want
    # the alert of the last day has a baseline from the stored history
    a = daily_refresh(spark, o, c, "2001-07-01", root, keep_days=10).first()
    assert a.baseline_value is not None
    # the monthly layer from the stored profile equals cohorts over the same orders
    from cohortwise.operators.cohorts import cohort_retention
    from cohortwise.plans.daily import monthly_cohorts

    cut = o.where(F.col("order_date") <= F.lit(dt.date(2001, 7, 1)))
    assert _rows(monthly_cohorts(spark, root)) == _rows(cohort_retention(cut))


def test_streaming_profile_refresh_equals_rebuild(spark, tmp_dir):
    from cohortwise.operators.profile import customer_profile
    from cohortwise.streaming.incremental import start_profile_refresh

    raw = spark.read.parquet(f"{SF}/orders.parquet")
    inbox = os.path.join(tmp_dir, "inbox")
    cut = F.col("o_orderdate") <= F.lit(dt.datetime(1999, 1, 1))
    redelivery = raw.where(F.year("o_orderdate") == 1998)  # rows already seen arrive again

    def to_orders(df):
        return df.select(
            F.col("o_custkey").cast("long").alias("customer_id"), F.col("o_orderkey").cast("long").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderstatus").alias("order_status"))

    c = src.customers(spark, SF)
    table, ckpt, src_dir = os.path.join(tmp_dir, "profile"), os.path.join(tmp_dir, "ckpt"), os.path.join(inbox, "*")
    for i, part in enumerate((raw.where(cut), raw.where(~cut), redelivery)):
        part.coalesce(1).write.parquet(os.path.join(inbox, f"part{i}"))
        start_profile_refresh(spark, src_dir, raw.schema, to_orders, c, table, ckpt).awaitTermination(300)
    got = read_profile_version(spark, table)
    want = customer_profile(to_orders(raw.unionByName(redelivery)), c)
    assert _rows(got.select(*want.columns)) == _rows(want)
