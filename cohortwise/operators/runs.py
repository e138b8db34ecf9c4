"""Runs: how long each customer keeps the same status, signals and risk level.

On the days ``[o, nx)`` from one order day to the next, the as-of facts of a
customer stand still and only its recency grows by one a day. So status and
signals change on days that follow in closed form, without looking at any day
in between:

    AT_RISK            from o + active_days + 1
    INACTIVE           from o + at_risk_days + 1
    frequency drop     from o + floor(frequency % * lifetime / (100 * (n - 1))) + 1
    near its mean gap  likewise, with the inconsistency factor

(n orders, lifetime from first to last order day). Each interval is cut at
those of the days that lie in it; a piece is a *run* ``[from_day, to_day)``,
open if ``to_day`` is NULL. Everything that asks for customers by day is read
off the runs, at most five per order day, never off customers x days:

* ``daily_counts``  customers per category on every day (+1 / -1 events)
* ``flow_matrix``   who moved from what to what, between any two days in a row
* ``as_of``         the snapshot of any day, from the stored runs of a table

Shuffles: ``order_day_facts`` groups orders by (customer, order id, day), so a
hot customer is spread over its orders, then reduces per customer day; windows
run per customer and hold at most one row per calendar day. The rest is narrow
apart from sums over (category, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.config import RiskWeights, StatusThresholds
from cohortwise.functions.dates import date_lit, day_diff, month_start
from cohortwise.operators.risk import RISK_COLUMNS, churn_detection
from cohortwise.operators.status import STATUS_COLUMNS, status_expr

NOT_A_CUSTOMER = "NOT_A_CUSTOMER"


def order_day_facts(orders: DataFrame, end=None) -> DataFrame:
    """The as-of facts that hold from each distinct order day ``o`` to the day
    before the next one ``nx`` (NULL: for good): ``customer_id, o, nx, e``
    (entry day, the first with an order id), ``first_order_date,
    last_order_date, total_orders`` (distinct ids so far), ``total_revenue,
    avg_order_value, last_order_value``. Days before the entry day are left
    out. ``end`` cuts later orders, which only move ends beyond it."""
    o = orders.where(F.col("order_date").isNotNull())
    if end is not None:
        o = o.where(F.col("order_date") <= date_lit(end))
    per_order = o.groupBy("customer_id", "order_id", "order_date").agg(
        F.sum("order_amount").alias("revenue"), F.count("order_amount").alias("amounts"), F.max("order_amount").alias("amount"))
    # an id that comes again on a later day is no new order
    again = F.lag("order_date").over(Window.partitionBy("customer_id", "order_id").orderBy("order_date")).isNotNull()
    per_day = per_order.withColumn("new", (F.col("order_id").isNotNull() & ~again).cast("int")).groupBy("customer_id", "order_date").agg(
        F.sum("new").alias("new"), F.sum("revenue").alias("revenue"), F.sum("amounts").alias("amounts"),
        F.max_by("amount", F.struct("order_id")).alias("last_order_value"))
    whole = Window.partitionBy("customer_id")
    so_far = whole.orderBy("order_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    amounts = F.sum("amounts").over(so_far)
    revenue = F.sum("revenue").over(so_far)
    facts = per_day.select(
        "customer_id", F.col("order_date").alias("o"), F.lead("order_date").over(whole.orderBy("order_date")).alias("nx"),
        F.min(F.when(F.col("new") > 0, F.col("order_date"))).over(whole).alias("e"),
        F.min("order_date").over(so_far).alias("first_order_date"), F.col("order_date").alias("last_order_date"),
        F.sum("new").over(so_far).cast("long").alias("total_orders"), revenue.alias("total_revenue"),
        F.when(amounts > 0, revenue / amounts).alias("avg_order_value"), "last_order_value")
    return facts.where(F.col("e").isNotNull() & (F.col("nx").isNull() | (F.col("nx") > F.col("e"))))


def _cut(intervals: DataFrame, changes: list[Column], columns: list[str]) -> DataFrame:
    """Intervals ``[o, nx)`` cut at ``changes`` (days after ``o``; NULL: none)
    into runs, from the entry day ``e`` on."""
    low = F.greatest(F.lit(0), F.datediff("e", "o"))
    high = F.datediff("nx", "o")
    within = [F.when((c > low) & (high.isNull() | (c < high)), c.cast("int")) for c in changes]
    cuts = F.array_sort(F.array_distinct(F.array_compact(F.array(low, *within))))
    pieces = intervals.select(*columns, "o", "nx", cuts.alias("_cuts"))
    run = F.transform("_cuts", lambda c, i: F.struct(
        F.date_add("o", c).alias("from_day"),
        F.coalesce(F.date_add("o", F.try_element_at("_cuts", i + 2)), F.col("nx")).alias("to_day")))
    return pieces.select(*columns, "o", F.explode(run).alias("_run")).select(*columns, "o", "_run.*")


def status_runs(intervals: DataFrame, thresholds: StatusThresholds = StatusThresholds()) -> DataFrame:
    """``customer_id, last_order_date, retention_status, from_day, to_day`` of
    intervals (``customer_id, o, nx, e``: ``history.order_day_intervals``,
    ``profile.intervals_from_profile`` or ``order_day_facts``)."""
    runs = _cut(intervals, [F.lit(thresholds.active_days + 1), F.lit(thresholds.at_risk_days + 1)], ["customer_id"])
    status = status_expr(day_diff("o", "from_day"), thresholds.active_days, thresholds.at_risk_days)
    return runs.select("customer_id", F.col("o").alias("last_order_date"), status.alias("retention_status"), "from_day", "to_day")


def risk_runs(day_facts: DataFrame, thresholds: StatusThresholds = StatusThresholds(), weights: RiskWeights = RiskWeights(),
              keep: list[str] | None = None) -> DataFrame:
    """The risk layer's columns of every run (``days_since_last_order`` as on
    its first day), ``last_order_date, first_order_date, from_day, to_day`` and
    the columns of ``day_facts`` named in ``keep``. Customers without an id are
    left out, as there."""
    life, gaps = day_diff("first_order_date", "o"), F.col("total_orders") - 1

    def passes(percent: int) -> Column:
        """First day count d with 100 * d * gaps > percent * life."""
        scaled, per = life * F.lit(int(percent)), gaps * F.lit(100)
        return F.when(gaps > 0, ((scaled - F.pmod(scaled, per)) / per).cast("long") + 1)

    facts = ["customer_id", "first_order_date", "last_order_date", "total_orders", "total_revenue", "avg_order_value", "last_order_value"]
    changes = [F.lit(thresholds.active_days + 1), F.lit(thresholds.at_risk_days + 1), passes(weights.frequency_factor_pct),
               passes(weights.inconsistency_factor_pct)]
    extra = [c for c in keep or [] if c not in facts]
    runs = _cut(day_facts, changes, facts + extra).drop("o")
    return churn_detection(runs, F.col("from_day"), thresholds, weights,
                           keep=["last_order_date", "first_order_date", "from_day", "to_day", *extra])


def daily_counts(events: DataFrame, keys: list[str], start, end) -> DataFrame:
    """``events`` (``keys``, ``day``, ``delta``) summed up to every day of
    [start, end] on which the sum is not zero: ``keys, snapshot_date,
    customer_count``. Events before ``start`` count on it; a running sum holds
    at most one row per key and calendar day."""
    s, t = date_lit(start), date_lit(end)
    per_day = events.where(F.col("day") <= t).groupBy(*keys, F.greatest("day", s).alias("day")).agg(F.sum("delta").alias("delta"))
    w = Window.partitionBy(*keys).orderBy("day")
    steps = per_day.select(
        *keys, "day", F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long").alias("customer_count"),
        F.coalesce(F.date_sub(F.lead("day").over(w), 1), t).alias("last_day")).where(F.col("customer_count") != 0)
    return steps.select(*keys, F.explode(F.sequence("day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("snapshot_date"), "customer_count")


def run_events(runs: DataFrame, keys: list[str]) -> DataFrame:
    """+1 on the first day of a run and -1 on the day after its last."""
    ends = F.array(F.struct(F.col("from_day").alias("day"), F.lit(1).alias("delta")), F.struct(F.col("to_day").alias("day"), F.lit(-1).alias("delta")))
    return runs.select(*keys, F.inline(ends)).where(F.col("day").isNotNull())


def risk_history(runs: DataFrame, start, end, by: list[str] | None = None) -> DataFrame:
    """Customers per risk level on every day of [start, end]: ``by,
    snapshot_date, churn_risk_level, customer_count, total_customers,
    level_pct`` (share within ``by`` and day, 2 decimals). ``by``: columns of
    the runs, such as ``retention_status`` or a ``cohort_month``."""
    keys = list(by or [])
    counts = daily_counts(run_events(runs, [*keys, "churn_risk_level"]), [*keys, "churn_risk_level"], start, end)
    total = F.sum("customer_count").over(Window.partitionBy(*keys, "snapshot_date"))
    out = counts.withColumn("total_customers", total.cast("long"))
    return out.withColumn("level_pct", F.round(F.col("customer_count").cast("double") * 100.0 / F.col("total_customers").cast("double"), 2)).select(
        *keys, "snapshot_date", "churn_risk_level", "customer_count", "total_customers", "level_pct")


def with_cohort_month(runs: DataFrame) -> DataFrame:
    return runs.withColumn("cohort_month", month_start("first_order_date"))


def flow_matrix(runs: DataFrame, start, end, col: str = "retention_status") -> DataFrame:
    """Customers by their ``col`` the day before and on each day of [start,
    end]: ``snapshot_date, from_<col>, to_<col>, customer_count``. New ones
    come from NOT_A_CUSTOMER. A run's first day is a move unless the run before
    it was alike; its other days are stays, which need two events."""
    w = Window.partitionBy("customer_id").orderBy("from_day")
    lined = runs.select("customer_id", "from_day", "to_day", F.col(col).alias("to"), F.lag(col).over(w).alias("before"),
                        F.row_number().over(w).alias("nth")).withColumn(
        "from", F.when(F.col("nth") == 1, F.lit(NOT_A_CUSTOMER)).otherwise(F.col("before")))
    s, t = date_lit(start), date_lit(end)
    same = F.col("from").eqNullSafe(F.col("to"))
    moves = lined.where(~same & F.col("from_day").between(s, t)).groupBy(F.col("from_day").alias("snapshot_date"), "from", "to").agg(
        F.count(F.lit(1)).alias("customer_count"))
    stay = lined.select(F.col("to"), F.when(same, F.col("from_day")).otherwise(F.date_add("from_day", 1)).alias("from_day"), "to_day").where(
        F.col("to_day").isNull() | (F.col("from_day") < F.col("to_day")))
    stays = daily_counts(run_events(stay, ["to"]), ["to"], start, end).select(
        "snapshot_date", F.col("to").alias("from"), "to", "customer_count")
    return moves.unionByName(stays).select("snapshot_date", F.col("from").alias(f"from_{col}"), F.col("to").alias(f"to_{col}"), "customer_count")


def on_days(runs: DataFrame, days: list) -> DataFrame:
    """The runs with ``snapshot_date`` and that day's ``days_since_last_order``,
    each under those of a few ``days`` that lie in it; nothing is joined."""
    open_ = F.col("to_day").isNull()
    within = F.filter(F.array(*[date_lit(d) for d in days]), lambda d: (d >= F.col("from_day")) & (open_ | (d < F.col("to_day"))))
    return runs.withColumn("snapshot_date", F.explode(within)).withColumn(
        "days_since_last_order", day_diff("last_order_date", "snapshot_date"))


def as_of(runs: DataFrame, days: list, keep: list[str] | None = None) -> DataFrame:
    """Snapshots (``STATUS_COLUMNS``) of a few days from status runs."""
    return on_days(runs, days).select(*STATUS_COLUMNS, *(keep or []))


def risk_as_of(runs: DataFrame, days: list, keep: list[str] | None = None) -> DataFrame:
    """Risk rows with ``snapshot_date`` of a few days from risk runs; scores
    and levels are the run's, recency is that of the day."""
    return on_days(runs, days).select(*RISK_COLUMNS, "snapshot_date", *(keep or []))


def daily_snapshots(runs: DataFrame, start, end) -> DataFrame:
    """Snapshots (``STATUS_COLUMNS``) of every day of [start, end] from status
    runs: a row per customer and day, as the daily table holds them."""
    s, t = date_lit(start), date_lit(end)
    first, last = F.greatest("from_day", s), F.least(F.coalesce(F.date_sub("to_day", 1), t), t)
    days = runs.where(first <= last).withColumn("snapshot_date", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))
    return days.withColumn("days_since_last_order", day_diff("last_order_date", "snapshot_date")).select(*STATUS_COLUMNS)


def level_changes(runs: DataFrame, start, end, min_increase: int = 20) -> DataFrame:
    """X2 by day: every change of a customer's score in [start, end], with the
    score and level before it (NULL for a new customer, whose score counts from
    0): ``customer_id, change_date, retention_status, previous_score,
    previous_level, churn_risk_score, churn_risk_level, score_change,
    is_significant_increase``."""
    w = Window.partitionBy("customer_id").orderBy("from_day")
    lined = runs.select("customer_id", "from_day", "retention_status", F.lag("churn_risk_score").over(w).alias("previous_score"),
                        F.lag("churn_risk_level").over(w).alias("previous_level"), "churn_risk_score", "churn_risk_level")
    change = F.col("churn_risk_score") - F.coalesce(F.col("previous_score"), F.lit(0))
    changed = F.col("from_day").between(date_lit(start), date_lit(end)) & ~F.col("previous_score").eqNullSafe(F.col("churn_risk_score"))
    return lined.where(changed).select(
        "customer_id", F.col("from_day").alias("change_date"), "retention_status", "previous_score", "previous_level", "churn_risk_score",
        "churn_risk_level", change.alias("score_change"), (change >= int(min_increase)).alias("is_significant_increase"))
