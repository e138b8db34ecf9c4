"""The single-shuffle customer profile reproduces every layer it feeds."""

import datetime as dt

from cohortwise.operators import cohorts as CH
from cohortwise.operators import facts as FX
from cohortwise.operators import history as HI
from cohortwise.operators import profile as PR
from cohortwise.sources import testdata as src

SF = "/root/testdata/sf0.001"


def _rows(df):
    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in df.collect()), key=repr)


def test_profile_feeds_facts_cohorts_history(spark):
    o, c = src.orders(spark, SF), src.customers(spark, SF)
    prof = PR.customer_profile(o, c)
    assert _rows(PR.facts_from_profile(prof)) == _rows(FX.base_customers(o, c))
    assert _rows(CH.cohort_retention(None, months=PR.customer_months_from_profile(prof))) == \
        _rows(CH.cohort_retention(o))
    a = HI.status_history(None, "1999-01-01", "2001-07-31", intervals=PR.intervals_from_profile(prof))
    assert _rows(a) == _rows(HI.status_history(o, "1999-01-01", "2001-07-31"))


def test_profile_edge_rows(spark):
    D = dt.date.fromisoformat
    rows = [(1, 1, "2024-01-01"), (1, 2, "2024-01-01"), (2, None, "2024-01-03"), (2, 4, "2024-01-10"),
            (None, 5, "2024-01-05"), (4, None, "2024-01-02"), (5, 8, None), (6, 9, "2024-02-15"), (6, 9, "2024-02-16")]
    o = spark.createDataFrame([(c, i, D(d) if d else None, 1.0, None) for c, i, d in rows],
                              "customer_id long, order_id long, order_date date, order_amount double, order_status string")
    cust = spark.createDataFrame([], "customer_id long, customer_email string, country string, customer_segment string, "
                                     "acquisition_channel string, signup_date date")
    prof = PR.customer_profile(o, cust)
    assert _rows(PR.facts_from_profile(prof)) == _rows(FX.base_customers(o, cust))
    assert _rows(PR.intervals_from_profile(prof)) == _rows(HI.order_day_intervals(o).select("customer_id", "o", "nx", "e"))
    assert _rows(CH.cohort_retention(None, months=PR.customer_months_from_profile(prof))) == \
        _rows(CH.cohort_retention(o))


def test_merge_profile_equals_rebuild(spark):
    from pyspark.sql import functions as F

    from cohortwise.streaming.incremental import empty_ledger, merge_profile

    o, c = src.orders(spark, SF), src.customers(spark, SF)
    b1 = o.where(F.col("order_date") <= F.lit(dt.date(1998, 1, 1)))
    b2 = o.where(F.col("order_date") > F.lit(dt.date(1998, 1, 1)))
    # the same order rows arrive again (a re-delivery): revenue counts them twice, order counts do not
    redelivered = o.where((F.col("customer_id") % 7 == 0) & (F.year("order_date") == 1999))
    prof, led = PR.customer_profile(o.limit(0), c), empty_ledger(spark)
    for batch in (b1, b2, redelivered):
        prof, fresh = merge_profile(prof, led, batch, c)
        led = led.unionByName(fresh)
    full = PR.customer_profile(o.unionByName(redelivered), c)
    got, want = _rows(prof), _rows(full)
    assert [r for r in got if r not in want][:2] == [] and len(got) == len(want)
    assert led.count() == o.select("customer_id", "order_id").distinct().count()
