"""The alert as a stateful stream over daily status shares.

Input rows are days of a distribution (``snapshot_date, retention_status,
status_pct, total_customers`` and scope keys), in any chunks. Per scope the
state store keeps the last days in a ring: as many as the baseline and the
streak look back, plus ``late_days`` for days that arrive late or again. A
micro-batch is merged into the ring by day, and every day from the first
changed one on is judged again and emitted with a higher ``revision``; the
newest revision of a (scope, day) is what the batch operator ``alert_logic``
gives for the same days. A day too old for the ring cannot be judged any more:
it is emitted with ``too_late`` instead of being lost.

The state is bounded per scope; scopes are spread over the shuffle partitions.
"""

from __future__ import annotations

import statistics
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from cohortwise.config import CRITICAL, INFO, WARNING, AlertConfig
from cohortwise.operators.alerts import ALERT_COLUMNS

LATE_DAYS = 30
STATE = "days array<int>, pct array<double>, total array<long>, raw array<boolean>, revision int, cut boolean"
OUTPUT = ("scope string, day int, current_value double, baseline_value double, delta_pct double, delta_relative_pct double, "
          "severity string, alert_flag boolean, sample_size long, revision int, too_late boolean")


def _half_up(x: float) -> float:
    """Two digits, halves away from zero, as the batch operator rounds."""
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def look_back(cfg: AlertConfig) -> int:
    """Days before a day that its judgement may ask for."""
    return max(7 if cfg.baseline == "same_day_last_week" else cfg.baseline_rows, cfg.consecutive_days)


def _baseline(days: list[int], pct: list[float | None], at: int, cfg: AlertConfig) -> tuple[float | None, int]:
    """(baseline, days it used) of the day at position ``at``."""
    if cfg.baseline in ("rows", "median"):
        used = pct[max(at - cfg.baseline_rows, 0):at]
    else:
        low, high = (7, 7) if cfg.baseline == "same_day_last_week" else (cfg.baseline_rows, 1)
        used = [p for d, p in zip(days[:at], pct[:at]) if days[at] - low <= d <= days[at] - high]
    used = [p for p in used if p is not None]
    if not used:
        return None, 0
    return (statistics.median(used) if cfg.baseline == "median" else sum(used) / len(used)), len(used)


def judged(days: list[int], pct: list[float | None], total: list[int], raw: list[bool], at: int, cfg: AlertConfig) -> tuple:
    """One day's (baseline, delta, relative delta, severity, raw flag, flag);
    ``raw`` holds the raw flags of the days before it."""
    base, n = _baseline(days, pct, at, cfg)
    base = base if n >= cfg.min_history else None
    now = pct[at]
    delta = now - base if now is not None and base is not None else None
    relative = _half_up((now / base - 1) * 100) if delta is not None and base != 0 else None
    worse = None if relative is None else relative if cfg.direction == "increase" else -relative
    severity = INFO if worse is None or worse < min(cfg.warning_pct, cfg.critical_pct) else CRITICAL if worse >= cfg.critical_pct else WARNING
    loud = total[at] is not None and total[at] >= cfg.min_sample and base is not None and severity != INFO
    before = {d for d, r in zip(days[:at], raw[:at]) if r}
    flag = loud and all(days[at] - k in before for k in range(1, cfg.consecutive_days))
    return base, delta, relative, severity, loud, flag


def _step(cfg: AlertConfig, keep: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        days, pct, total, raw, revision, cut = state.get if state.exists else ([], [], [], [], 0, False)
        ring = {d: (p, n, r) for d, p, n, r in zip(days, pct, total, raw)}
        # the first day that still has all days in the ring that its judgement may ask for
        first = sorted(days)[min(look_back(cfg), len(days) - 1)] if cut else None
        late, changed = [], []
        for batch in batches:
            for d, p, n in zip(batch["day"].tolist(), batch["status_pct"].tolist(), batch["total_customers"].tolist()):
                p = None if p != p else p
                if d in ring and ring[d][:2] == (p, n):
                    continue  # delivered again
                if cut and d < first:
                    late.append(d)
                else:
                    ring[d] = (p, n, False)
                    changed.append(d)
        days = sorted(ring)
        pct, total, raw = ([ring[d][k] for d in days] for k in range(3))
        revision, rows = revision + 1, []
        for at in range(days.index(min(changed)) if changed else len(days), len(days)):
            base, delta, relative, severity, raw[at], flag = judged(days, pct, total, raw, at, cfg)
            rows.append((key[0], days[at], pct[at], base, delta, relative, severity, flag, total[at], revision, False))
        rows += [(key[0], d, None, None, None, None, None, False, None, revision, True) for d in sorted(set(late))]
        state.update((days[-keep:], pct[-keep:], total[-keep:], raw[-keep:], revision, cut or len(days) > keep))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUTPUT.split(", ")]).astype({"sample_size": "Int64"})

    return step


def alert_stream(distribution: DataFrame, cfg: AlertConfig = AlertConfig(), by: list[str] | None = None,
                 late_days: int = LATE_DAYS) -> DataFrame:
    """The columns of ``alert_logic``, ``revision`` and ``too_late``, of a
    streaming distribution; output mode *update*."""
    keys = list(by or [])
    scope = F.lit(cfg.scope) if not keys else F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    rows = distribution.where(F.col("retention_status") == F.lit(cfg.status)).select(
        scope.alias("scope"), F.unix_date("snapshot_date").alias("day"), F.col("status_pct").cast("double").alias("status_pct"),
        F.col("total_customers").cast("long").alias("total_customers"))
    keep = look_back(cfg) + int(late_days)
    out = rows.groupBy("scope").applyInPandasWithState(_step(cfg, keep), OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
    return out.select(*_columns(cfg), "revision", "too_late")


def _columns(cfg: AlertConfig) -> list:
    named = {"alert_date": F.date_from_unix_date("day"), "alert_type": F.lit(cfg.alert_type), "metric_name": F.lit(cfg.metric_name),
             "threshold_warning": F.lit(float(cfg.warning_pct)), "threshold_critical": F.lit(float(cfg.critical_pct))}
    return [named.get(c, F.col(c)).alias(c) for c in ALERT_COLUMNS]


def start_alert_stream(spark: SparkSession, distribution_dir: str, schema: str, table: str, checkpoint: str,
                       cfg: AlertConfig = AlertConfig(), by: list[str] | None = None, late_days: int = LATE_DAYS, trigger_once: bool = True):
    """Streams new files of ``distribution_dir`` into ``table``: every
    micro-batch is a folder of its own, replaced if the batch runs again."""
    days = spark.readStream.schema(schema).parquet(distribution_dir)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table.rstrip('/')}/batch={epoch}")

    w = alert_stream(days, cfg, by, late_days).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def read_alerts(spark: SparkSession, table: str, too_late: bool = False) -> DataFrame:
    """The newest judgement of every (scope, day); with ``too_late`` the days
    that arrived after the ring had passed them."""
    rows = spark.read.parquet(table)
    if too_late:
        return rows.where("too_late").select("scope", "alert_date").distinct()
    last = Window.partitionBy("scope", "alert_date").orderBy(F.desc("revision"))
    return rows.where("NOT too_late").withColumn("_nth", F.row_number().over(last)).where("_nth = 1").select(*ALERT_COLUMNS)
