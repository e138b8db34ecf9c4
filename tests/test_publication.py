"""Days published as a whole, and layers stored in buckets alike."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import facts as FX
from cohortwise.operators import risk as RK
from cohortwise.operators import status as ST
from cohortwise.plans.daily import publish_day
from cohortwise.sources import publication as PB
from cohortwise.sources import testdata as src

SF = "/root/testdata/sf0.001"
LAYERS = ["profile", "snapshots", "risk", "distribution", "alerts", "outbox"]


@pytest.fixture(scope="module")
def data(spark):
    o = src.orders(spark, SF).where("customer_id <= 40").cache()
    return o, src.customers(spark, SF).where("customer_id <= 40").cache()


def state(spark, root):
    p = PB.Publication(spark, root)
    return {layer: sorted(map(str, p.read(layer).collect())) for layer in p.manifest()}


def test_a_broken_day_leaves_yesterday_readable(spark, data, tmp_dir):
    o, c = data
    root = f"{tmp_dir}/p"
    publish_day(spark, o, c, "2001-03-01", root)
    yesterday = state(spark, root)
    assert set(yesterday) == set(LAYERS)
    for layer in LAYERS:
        with pytest.raises(RuntimeError):
            publish_day(spark, o, c, "2001-03-02", root, fail_after=layer)
        assert state(spark, root) == yesterday and PB.Publication(spark, root).runs() == [0]
    publish_day(spark, o, c, "2001-03-02", root)
    p = PB.Publication(spark, root)
    assert sorted(p.manifest()["risk"]) == ["2001-03-01", "2001-03-02"] and list(p.manifest()["profile"]) == [""]
    want = RK.churn_detection(FX.base_customers(o, c, as_of="2001-03-02"), "2001-03-02")
    got = p.read("risk", ["2001-03-02"])
    assert sorted(r.customer_id for r in got.collect()) == sorted(r.customer_id for r in want.collect())
    # the older state is still there for readers that hold its number
    assert state(spark, root) != yesterday and sorted(map(str, p.read("risk", run=0).collect())) == yesterday["risk"]


def test_a_day_again_replaces_its_parts_and_vacuum_keeps_what_is_named(spark, data, tmp_dir):
    o, c = data
    root = f"{tmp_dir}/p"
    for day in ("2001-03-01", "2001-03-02", "2001-03-02"):
        publish_day(spark, o, c, day, root)
    with pytest.raises(RuntimeError):
        publish_day(spark, o, c, "2001-03-03", root, fail_after="snapshots")
    publish_day(spark, o, c, "2001-03-03", root)
    p = PB.Publication(spark, root)
    before = state(spark, root)
    days = {r.snapshot_date for r in p.read("snapshots").select("snapshot_date").distinct().collect()}
    assert days == {dt.date(2001, 3, n) for n in (1, 2, 3)}
    assert p.read("snapshots", ["2001-03-02"]).count() == p.read("snapshots", ["2001-03-02"]).select("customer_id").distinct().count()
    gone = p.vacuum(keep=1)
    assert "profile/run=0" in gone and "snapshots/run=1" in gone and state(spark, root) == before
    assert len(p.runs()) == 1 and p.vacuum(keep=1) == []


def test_old_days_leave_the_state(spark, data, tmp_dir):
    o, c = data
    root = f"{tmp_dir}/p"
    for day in ("2001-01-01", "2001-02-20", "2001-03-03"):
        publish_day(spark, o, c, day, root, keep_days=30)
    m = PB.Publication(spark, root).manifest()
    assert sorted(m["snapshots"]) == sorted(m["risk"]) == ["2001-02-20", "2001-03-03"] and len(m["distribution"]) == 3


def test_nothing_published(spark, tmp_dir):
    p = PB.Publication(spark, f"{tmp_dir}/none")
    assert p.runs() == [] and p.manifest() == {}
    with pytest.raises(ValueError):
        p.read("risk")


def test_copartitioned_layers_join_without_an_exchange(spark, data, tmp_dir):
    o, c = data
    facts = FX.base_customers(o, c)
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("facts", "snapshots", "again")]
    PB.write_copartitioned(facts, names[0], f"{tmp_dir}/facts", 4)
    both = ST.retention_status(facts, "2001-07-31").unionByName(ST.retention_status(facts, "2001-03-01"))
    PB.write_copartitioned(both, names[1], f"{tmp_dir}/snapshots", 4, by="snapshot_date")
    stored = RK.churn_detection(spark.table(names[0]), "2001-07-31", snapshot=spark.table(names[1]).hint("merge"))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("FileScan parquet") == 2
    want = RK.churn_detection(facts, "2001-07-31")
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))
    # another session knows the files by their folder only
    schema = "customer_id long, last_order_date date, days_since_last_order long, retention_status string, snapshot_date date"
    opened = PB.open_copartitioned(spark, names[2], f"{tmp_dir}/snapshots", schema, 4, by="snapshot_date")
    assert opened.count() == both.count()
    again = RK.churn_detection(spark.table(names[0]), "2001-07-31", snapshot=opened.hint("merge"))
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, again.collect())) == sorted(map(str, want.collect()))
