"""Sinks: the materialized layer tables.

* facts     — partitioned by first-order *month* (a day would make tiny files);
              a write replaces the whole table
* snapshots — partitioned by ``snapshot_date``; a rerun of a day replaces only
              that day (dynamic partition overwrite), so daily writes are
              idempotent; ``keep_recent`` enforces the retention policy
* snapshot runs — the snapshots of all days as one row per customer and status
              run, partitioned by the month in which the run ends; a day is read
              back by ``read_snapshot_days``, ``expire_runs`` drops what ended
              before the days to keep
* cohorts   — partitioned by ``cohort_month``; a write replaces the whole table
* distribution — status counts per day (tiny), what the alert reads
* risk      — partitioned by ``snapshot_date`` like the snapshots
* outbox    — flagged alerts (one row per destination), partitioned by
              ``alert_date``; a rerun of a day replaces that day's alerts

Before a partitioned write the rows are rebalanced by the partition column:
AQE splits large partitions over as many tasks as their size asks for and
merges small ones, so nothing fixes the number of writers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.dates import month_start


#: Rows of one file of a partitioned table; more go to further files.
ROWS_PER_FILE = 5_000_000


def _partitioned(df: DataFrame, part_col: str, mode: str):
    w = df.hint("rebalance", part_col).write.mode("overwrite").option("partitionOverwriteMode", mode)
    return w.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(part_col)


def write_facts(facts: DataFrame, path: str) -> None:
    """SNK1 — facts table partitioned by ``first_order_month``; replaces the
    table, so no month of an earlier write survives."""
    df = facts.withColumn("first_order_month", month_start("first_order_date"))
    _partitioned(df, "first_order_month", "static").parquet(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("first_order_month")


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """SNK2 — append / replace the snapshot days present in ``snapshot``;
    other days already in the table are untouched."""
    _partitioned(snapshot, "snapshot_date", "dynamic").parquet(path)


def read_snapshot(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """SRC4 — partition-pruned read of the snapshot days in [start, end]."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col("snapshot_date") >= F.lit(_as_date(start)))
    if end is not None:
        df = df.where(F.col("snapshot_date") <= F.lit(_as_date(end)))
    return df


#: Partition of the runs that have not ended.
OPEN_MONTH = _dt.date(9999, 12, 1)


def write_snapshot_runs(runs: DataFrame, path: str) -> None:
    """SNK2 as intervals — ``customer_id, last_order_date, retention_status,
    from_day, to_day`` (see ``operators.runs.status_runs``); replaces the table.
    Rows grow with order days, not with customers x days."""
    ended = F.coalesce(month_start("to_day"), F.lit(OPEN_MONTH))
    _partitioned(runs.withColumn("ended_month", ended), "ended_month", "static").parquet(path)


def read_snapshot_days(spark: SparkSession, path: str, days: list) -> DataFrame:
    """SRC4 — the snapshots of some days off the run table: runs that ended in
    an earlier month are pruned as partitions, later ones by ``from_day``."""
    from cohortwise.operators.runs import as_of

    wanted = [_as_date(d) for d in days]
    runs = spark.read.parquet(path).where((F.col("ended_month") >= F.lit(min(wanted).replace(day=1)))
                                          & (F.col("from_day") <= F.lit(max(wanted))))
    return as_of(runs, wanted)


def expire_runs(spark: SparkSession, path: str, reference_date, keep_days: int = 90) -> list[str]:
    """X24 on the run table — drops the months of runs that all ended before
    ``reference_date - keep_days``; days from there on read as before."""
    cutoff = (_as_date(reference_date) - _dt.timedelta(days=int(keep_days))).replace(day=1)
    return _drop_partitions(spark, path, "ended_month", cutoff)


def write_distribution(distribution: DataFrame, path: str) -> None:
    """The daily status distribution (a few rows per day), partitioned by
    ``snapshot_date`` with dynamic overwrite: what the alert reads."""
    _partitioned(distribution, "snapshot_date", "dynamic").parquet(path)


def write_cohorts(cohorts: DataFrame, path: str) -> None:
    """SNK3 — cohort table partitioned by ``cohort_month`` (tiny: cohorts x
    months); replaces the table."""
    _partitioned(cohorts, "cohort_month", "static").parquet(path)


def write_outbox(routed_alerts: DataFrame, path: str, fmt: str = "json", days=None) -> None:
    """SNK4 — flagged, routed alerts for downstream delivery. A day written
    again replaces its alerts; ``days`` names the evaluated days, whose
    earlier alerts go even if none is flagged now."""
    for day in days or []:
        _delete(routed_alerts.sparkSession, f"{path.rstrip('/')}/alert_date={_as_date(day).isoformat()}")
    w = routed_alerts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("alert_date")
    (w.json(path) if fmt == "json" else w.parquet(path))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def _as_date(d) -> _dt.date:
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


def keep_recent(spark: SparkSession, path: str, reference_date, keep_days: int = 90) -> list[str]:
    """X24 — drop snapshot partitions older than ``reference_date - keep_days``.
    Works on partition directories (metadata only, no data is read);
    returns the removed partition values."""
    return _drop_partitions(spark, path, "snapshot_date", _as_date(reference_date) - _dt.timedelta(days=int(keep_days)))


def _drop_partitions(spark: SparkSession, path: str, column: str, before: _dt.date) -> list[str]:
    """Deletes the folders of a date partition column below ``before``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    removed = []
    for st in fs.listStatus(root) if fs.exists(root) else []:
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{column}="):
            day = _dt.date.fromisoformat(name.split("=", 1)[1])
            if day < before:
                fs.delete(st.getPath(), True)
                removed.append(day.isoformat())
    return sorted(removed)
