"""Replays, crashes and shrinking tables: nothing stale, nothing twice."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import alerts as AL
from cohortwise.operators import cohorts as CH
from cohortwise.operators import facts as FX
from cohortwise.operators import history as HI
from cohortwise.operators import profile as PR
from cohortwise.operators import quality as QC
from cohortwise.plans.daily import daily_incremental, daily_refresh
from cohortwise.sources import tables as T
from cohortwise.sources import testdata as src
from cohortwise.streaming import incremental as INC
from cohortwise.streaming.versions import VersionedTable

SF = "/root/testdata/sf0.001"
ORDERS = "customer_id long, order_id long, order_date date, order_amount double, order_status string"


def D(x):
    return dt.date.fromisoformat(x)


def _rows(df):
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)


def _orders(spark, rows):
    return spark.createDataFrame([(c, i, D(d), float(a), "F") for c, i, d, a in rows], ORDERS)


@pytest.fixture(scope="module")
def data(spark):
    o, c = src.orders(spark, SF).cache(), src.customers(spark, SF).cache()
    return o, c, [o.where("order_date <= '1997-01-01'"), o.where("order_date > '1997-01-01' AND order_date <= '2000-01-01'"),
                  o.where("order_date > '2000-01-01'")]


def _state(spark, table):
    p = INC.read_profile_version(spark, table)
    return _rows(p.select(*sorted(set(p.columns) - {"bucket"}))), _rows(INC.read_ledger(spark, table))


def test_profile_epochs_replay_and_crash(spark, data, tmp_dir):
    o, c, parts = data
    table = os.path.join(tmp_dir, "t")
    for epoch, part in enumerate(parts):
        INC.merge_profile_epoch(spark, table, epoch, part, c, buckets=4)
        before = _state(spark, table)
        INC.merge_profile_epoch(spark, table, epoch, part, c, buckets=4)  # a published epoch runs again
        assert _state(spark, table) == before
    want = PR.customer_profile(o, c)
    assert before[0] == _rows(want.select(*sorted(want.columns)))
    assert before[1] == _rows(o.select("customer_id", "order_id").distinct())
    for broken in ("ledger", "profile"):  # crashes between the parts, then runs again
        with pytest.raises(RuntimeError):
            INC.merge_profile_epoch(spark, table, 2, parts[2], c, buckets=4, fail_after=broken)
        assert VersionedTable(spark, table).epochs() == [0, 1]
        INC.merge_profile_epoch(spark, table, 2, parts[2], c, buckets=4)
        assert _state(spark, table) == before
    with pytest.raises(ValueError):
        INC.merge_profile_epoch(spark, table, 1, parts[1], c, buckets=4)  # has a successor


def test_only_touched_buckets_are_written_and_versions_expire(spark, data, tmp_dir):
    o, c, _ = data
    table = os.path.join(tmp_dir, "t")
    INC.merge_profile_epoch(spark, table, 0, o, c, buckets=8)
    one = o.where("customer_id = 1").select("customer_id", (F.col("order_id") + 10**9).alias("order_id"), "order_date",
                                            "order_amount", "order_status")
    for epoch in (1, 2, 3):
        INC.merge_profile_epoch(spark, table, epoch, one, c, buckets=8)
    v = VersionedTable(spark, table)
    assert len(v._names("profile/epoch=3", "bucket=")) == 1 and len(v._names("profile/epoch=0", "bucket=")) == 7
    assert v._names("profile/epoch=1", "bucket=") == []  # two newer versions replace it
    assert INC.read_profile_version(spark, table).count() == PR.customer_profile(o, c).count()


def test_facts_epoch_replay(spark, data, tmp_dir):
    o, c, parts = data
    table = os.path.join(tmp_dir, "f")
    INC.merge_facts_epoch(spark, table, 0, parts[0], parts[0], c)
    for _ in range(2):
        INC.merge_facts_epoch(spark, table, 1, parts[1].unionByName(parts[2]), o, c)
        got = INC.read_facts_version(spark, table)
        assert _rows(got.select(*FX.FACT_COLUMNS)) == _rows(FX.base_customers(o, c))


def test_fresh_checkpoint_over_a_table_is_refused(spark, data, tmp_dir):
    o, c, parts = data
    table = os.path.join(tmp_dir, "t")
    INC.merge_profile_epoch(spark, table, 0, parts[0], c, buckets=2)
    with pytest.raises(ValueError):
        INC.start_profile_refresh(spark, tmp_dir, o.schema, lambda x: x, c, table, os.path.join(tmp_dir, "new"))


def test_late_order_and_older_date_leave_nothing_behind(spark, tmp_dir):
    c = spark.createDataFrame([(i, None, "BE", "B2C", None, None) for i in (1, 2)],
                              "customer_id long, customer_email string, country string, customer_segment string, "
                              "acquisition_channel string, signup_date date")
    o = _orders(spark, [(1, 1, "2024-01-10", 5), (2, 2, "2024-03-20", 5)])
    daily_refresh(spark, o, c, "2024-03-31", tmp_dir)
    late = o.unionByName(_orders(spark, [(2, 3, "2024-02-20", 7)]))
    daily_refresh(spark, late, c, "2024-04-01", tmp_dir)  # customer 2 moves from March to February
    facts = T.read_facts(spark, f"{tmp_dir}/facts")
    assert sorted(r.customer_id for r in facts.collect()) == [1, 2]
    daily_refresh(spark, o, c, "2024-01-31", tmp_dir)
    assert [r.customer_id for r in T.read_facts(spark, f"{tmp_dir}/facts").collect()] == [1]
    january = T.read_snapshot(spark, f"{tmp_dir}/snapshots", "2024-01-31", "2024-01-31")
    assert [(r.customer_id, r.retention_status) for r in january.collect()] == [(1, "ACTIVE")]
    risk = T.read_snapshot(spark, f"{tmp_dir}/risk", "2024-04-01", "2024-04-01")
    assert {r.customer_id for r in risk.collect()} == {1, 2}


def test_cohort_table_shrinks(spark, tmp_dir):
    o = _orders(spark, [(1, 1, "2024-01-10", 5), (2, 2, "2024-02-20", 5)])
    path = os.path.join(tmp_dir, "cohorts")
    T.write_cohorts(CH.cohort_retention(o), path)
    T.write_cohorts(CH.cohort_retention(o.where("customer_id = 1")), path)
    assert [r.cohort_month for r in spark.read.parquet(path).collect()] == [D("2024-01-01")]


def test_outbox_rerun(spark, tmp_dir):
    def routed(last):
        dist = spark.createDataFrame(
            [(D("2024-03-01") + dt.timedelta(days=i), "AT_RISK", 200, 1000, v) for i, v in enumerate([20.0] * 7 + [last])],
            "snapshot_date date, retention_status string, customer_count long, total_customers long, status_pct double")
        return AL.route_alerts(AL.alert_logic(dist))

    out = os.path.join(tmp_dir, "outbox")
    for _ in range(2):
        T.write_outbox(routed(25.0), out, days=["2024-03-08"])
    assert spark.read.json(out).count() == 2
    T.write_outbox(routed(20.0), out, days=["2024-03-08"])  # corrected data: no alert any more
    assert not any(f.endswith(".json") for _, _, fs in os.walk(out) for f in fs)


def test_daily_incremental_equals_full(spark, data, tmp_dir):
    o, c, _ = data
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    days = ["2001-06-29", "2001-06-30"]
    for day, new in zip(days, (o.where(f"order_date <= '{days[0]}'"), o.where(f"order_date = '{days[1]}'"))):
        for _ in range(1 + (day == days[1])):  # the newest day runs twice
            daily_incremental(spark, new, c, day, a)
        daily_refresh(spark, o, c, day, b)
    for name in ("snapshots", "risk", "distribution"):
        left, right = (spark.read.parquet(f"{x}/{name}") for x in (a, b))
        assert _rows(left.select(*right.columns)) == _rows(right), name


def test_duplicate_master_rows_count_once(spark):
    o = _orders(spark, [(1, 1, "2024-01-10", 5), (2, 2, "2024-01-20", 5)])
    twice = spark.createDataFrame([(1, "A"), (1, "A"), (2, "A")], "customer_id long, seg string")
    assert CH.cohort_retention(o, attributes=twice, by=["seg"]).first().cohort_size == 2
    h = HI.status_history(o, "2024-01-10", "2024-01-25", attributes=twice, by=["seg"])
    assert h.agg(F.max("customer_count")).first()[0] == 2


def test_bands_without_data_have_a_verdict(spark):
    only = spark.createDataFrame([("INFO", 3.0)], "severity string, alert_count double")
    got = {r.severity: (r.alert_count, r.verdict) for r in QC.band_verdicts(only, "severity", "alert_count", QC.ALERT_MONTHLY_BANDS).collect()}
    assert got == {"INFO": (3.0, "NO_BAND"), "CRITICAL": (0.0, "OK"), "WARNING": (0.0, "OUT_OF_BAND")}


def test_building_a_query_starts_no_job_of_its_own(spark):
    import __spark_entry__ as E

    def jobs(name):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, SF)
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(ids)

    footers = jobs("base_customers")  # reads the schemas of the three tables
    for name in ("ab_thresholds", "qc_status_bands", "customer_status_month_ends", "segment_weights", "action_matrix"):
        assert jobs(name) <= footers, name


def test_two_dates_from_one_scan(spark):
    import __spark_entry__ as E

    for name, table in (("transition_matrix", "orders"), ("score_trend", "events"), ("risk_by_cohort", "orders")):
        df = E.queries()[name](spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        scans = [x for x in final.splitlines() if "FileScan parquet" in x and f"{table}.parquet" in x]
        assert len(scans) == 1, (name, len(scans))
        assert "NestedLoop" not in final and "Cartesian" not in final, name


def _history(spark, table):
    return _rows(INC.read_daily_history(spark, table, "1995-01-01", "2001-07-31"))


def test_series_is_retracted_replayed_and_recovered(spark, data, tmp_dir):
    """Late, repeated and replayed batches give the history of a rebuild; a crash publishes nothing."""
    o, c, parts = data
    late = parts[0].where("order_id % 3 = 0")
    batches = [parts[0].where("order_id % 3 <> 0"), parts[1].unionByName(late.where("order_id % 2 = 0")),
               parts[2].unionByName(late.where("order_id % 2 = 1")), parts[1].where("order_id % 4 = 0")]  # the last one was delivered before
    table = os.path.join(tmp_dir, "t")
    seen = None
    for epoch, part in enumerate(batches):
        seen = part if seen is None else seen.unionByName(part)
        want = _rows(HI.status_history(seen, "1995-01-01", "2001-07-31"))
        for _ in range(2):  # the newest epoch may run again
            INC.merge_profile_epoch(spark, table, epoch, part, c, buckets=4, series=INC.StatusThresholds())
            assert _history(spark, table) == want
    with pytest.raises(RuntimeError):
        INC.merge_profile_epoch(spark, table, 4, parts[0], c, buckets=4, series=INC.StatusThresholds(), fail_after="series")
    assert _history(spark, table) == want  # yesterday stays readable
    with pytest.raises(ValueError):
        INC.merge_profile_epoch(spark, table, 4, parts[0], c, buckets=4, series=INC.StatusThresholds(5, 9))
    with pytest.raises(ValueError):
        INC.merge_profile_epoch(spark, table, 4, parts[0], c, buckets=8)


def test_series_reads_the_touched_customers_only(spark, data, tmp_dir):
    """One order of one customer changes few days of the series, and reads one bucket."""
    o, c, _ = data
    table = os.path.join(tmp_dir, "t")
    INC.merge_profile_epoch(spark, table, 0, o, c, buckets=8)
    one = _orders(spark, [(1, 10**9, "1996-05-05", 3), (None, 10**9 + 1, "1996-05-05", 3)])
    INC.merge_profile_epoch(spark, table, 1, one, c, buckets=8, series=INC.StatusThresholds())  # summed up from the profile
    assert _history(spark, table) == _rows(HI.status_history(o.unionByName(one), "1995-01-01", "2001-07-31"))
    v = VersionedTable(spark, table)
    assert 1 <= len(v._names("profile/epoch=1", "bucket=")) <= 2
    again = _orders(spark, [(1, 10**9, "1996-05-09", 3)])
    before = spark.read.parquet(*v.newest("series"))
    rows = {(r.retention_status, r.day): r.delta for r in before.collect()}
    INC.merge_profile_epoch(spark, table, 2, again, c, series=INC.StatusThresholds())
    after = {(r.retention_status, r.day): r.delta for r in spark.read.parquet(*v.newest("series")).collect()}
    assert 0 < len({k for k in {*rows, *after} if rows.get(k) != after.get(k)}) <= 8
    assert len(v._names("profile/epoch=2", "bucket=")) == 1


def test_bucket_number_follows_the_first_batch(spark, data, tmp_dir, monkeypatch):
    o, c, _ = data
    monkeypatch.setattr(INC, "CUSTOMERS_PER_BUCKET", 20)
    table = os.path.join(tmp_dir, "t")
    INC.merge_profile_epoch(spark, table, 0, o, c)
    n = int(VersionedTable(spark, table).setting("buckets"))
    assert n >= o.select("customer_id").distinct().count() / 20 * 0.8 and n > 1
    assert INC.read_profile_version(spark, table).count() == PR.customer_profile(o, c).count()


def test_facts_stream_keeps_its_own_orders(spark, data, tmp_dir):
    """An epoch that runs again ignores what arrived after it."""
    o, c, parts = data
    table = os.path.join(tmp_dir, "f")
    for epoch, part in enumerate(parts[:2]):
        INC.merge_facts_epoch(spark, table, epoch, part, None, c)
    want = _rows(FX.base_customers(parts[0].unionByName(parts[1]), c))
    assert _rows(INC.read_facts_version(spark, table).select(*FX.FACT_COLUMNS)) == want
    INC.merge_facts_epoch(spark, table, 1, parts[1], None, c)
    assert _rows(INC.read_facts_version(spark, table).select(*FX.FACT_COLUMNS)) == want
    INC.merge_facts_epoch(spark, table, 2, parts[2], None, c)
    assert _rows(INC.read_facts_version(spark, table).select(*FX.FACT_COLUMNS)) == _rows(FX.base_customers(o, c))


def test_drilldown_reads_its_written_intervals_alone(spark):
    """Orders are read while the intervals are written, and not again; alerts and drill-down read these."""
    import __spark_entry__ as E

    for name in ("alert_drilldown", "alert_drilldown_top"):
        df = E.queries()[name](spark, SF)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [x for x in final.splitlines() if "FileScan parquet" in x]
        assert scans and all("/intervals-" in x for x in scans) and "NestedLoop" not in final and "Cartesian" not in final
