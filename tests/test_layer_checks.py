"""Fused and observed checks against the single ones."""

import datetime as dt

from pyspark.sql import functions as F

from cohortwise.operators import layer_checks as LC
from cohortwise.operators import quality as QC

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def snapshot(spark):
    rows = [(c, d, c % 50 - 3, "DATA_QUALITY_ISSUE" if c % 50 < 3 else "ACTIVE" if c % 50 < 20 else "AT_RISK")
            for c in range(200) for d in DAYS]
    rows += [(7, DAYS[0], 40, "AT_RISK"), (None, DAYS[0], 5, "ACTIVE"), (300, DAYS[1], None, "INACTIVE")]
    return spark.createDataFrame(rows, "customer_id long, snapshot_date date, days_since_last_order long, retention_status string")


def single(snap):
    """The same rows from the single checks."""
    out = {("Q4", r.retention_status, "customer_count"): r.customer_count for r in QC.status_distribution(snap).collect()}
    for r in QC.threshold_ranges(snap).collect():
        out |= {("Q6", r.retention_status, m): r[m] for m in ("min_days", "max_days") if r[m] is not None}
    (r,) = QC.snapshot_validation(snap).collect()
    out |= {("Q5", "all", m): r[m] for m in ("min_days", "max_days", "unique_customers", "total_rows", "future_orders")}
    out["Q7", "all", "multi_status_customers"] = QC.multi_status_customers(snap).count()
    return out


def rows_of(df):
    return {(r.check_id, r.item, r.metric): r.value for r in df.collect()}


def test_fused_equals_single(spark):
    snap = snapshot(spark)
    want = single(snap)
    assert want["Q7", "all", "multi_status_customers"] == 1 and rows_of(LC.snapshot_checks(snap)) == want


def test_one_scan_for_all(spark, tmp_dir):
    snapshot(spark).write.parquet(f"{tmp_dir}/s")
    stored = spark.read.parquet(f"{tmp_dir}/s")
    plan = LC.snapshot_checks(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_observed_while_written(spark, tmp_dir):
    snap = snapshot(spark)
    got = LC.write_observed(snap, lambda df: df.write.parquet(f"{tmp_dir}/s"))
    want = {k: v for k, v in single(snap).items() if k[0] != "Q7" and k[2] != "unique_customers"}
    assert rows_of(got) == want and spark.read.parquet(f"{tmp_dir}/s").count() == snap.count()


def test_risk_and_empty(spark):
    risk = spark.createDataFrame([("ACTIVE", "HIGH", 70), ("ACTIVE", "LOW", 0), ("AT_RISK", "LOW", -4), ("ACTIVE", "LOW", 101)],
                                 "retention_status string, churn_risk_level string, churn_risk_score int")
    got = rows_of(LC.risk_checks(risk))
    assert got == {("Q9", "ACTIVE|HIGH", "customer_count"): 1, ("Q9", "ACTIVE|LOW", "customer_count"): 2,
                   ("Q9", "AT_RISK|LOW", "customer_count"): 1, ("Q8", "HIGH", "customer_count"): 1, ("Q8", "LOW", "customer_count"): 3,
                   ("Q11", "all", "out_of_range"): 2}
    assert rows_of(LC.risk_checks(risk.where(F.lit(False)))) == {}
    empty = rows_of(LC.snapshot_checks(snapshot(spark).where(F.lit(False))))
    assert all(v == 0 for v in empty.values())
