"""Daily status history without expanding customers x days.

For one customer, the status on day ``s`` (as-of facts: orders on or
before ``s``) only depends on the latest distinct order date ``o <= s``.
So each distinct order date ``o`` with next distinct order date ``nx``
owns the days ``[o, nx)`` and, with thresholds ``a <= b``, contributes

    ACTIVE    on [o,       min(o+a+1, nx))
    AT_RISK   on [o+a+1,   min(o+b+1, nx))   (if non-empty)
    INACTIVE  on [o+b+1,   nx)               (if non-empty; open when nx is NULL)

clipped below at the customer's entry day ``e`` (first day with an order id,
the facts' ``total_orders >= 1``). Each interval becomes +1 at its start
and -1 at its end; the per-(day, status) sums are tiny, and a running sum
over days gives the count of every status on every day.

Cost: one shuffle of ``orders`` by customer carrying a partial
``collect_set`` of order days (a customer's buffer is bounded by calendar
days), then O(distinct customer-days) narrow rows, then O(event days x
statuses). The running-sum window is partitioned by (scope, status) and
holds at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.config import ACTIVE, AT_RISK, INACTIVE, StatusThresholds
from cohortwise.functions.dates import date_lit

HISTORY_COLUMNS = ["snapshot_date", "retention_status", "customer_count", "total_customers", "status_pct"]


def order_day_intervals(orders: DataFrame, end=None, attributes: DataFrame | None = None,
                        by: list[str] | None = None, with_revenue: bool = False) -> DataFrame:
    """One row per (customer, distinct order day): ``o``, ``nx`` (next
    distinct order day or NULL), ``e`` (entry day), plus ``by`` keys and,
    with ``with_revenue``, ``revenue_to_date`` (revenue of all orders up to
    and including ``o``: the as-of facts' ``total_revenue`` on ``[o, nx)``).

    Without revenue: one shuffle by customer of a partial ``collect_set`` of
    order days (a customer's buffer is bounded by calendar days, whatever
    its number of orders); ``nx`` comes from the sorted array.
    With revenue: days are first reduced per (customer, day) — spreading a
    hot customer by day — then a window per customer gives ``lead`` and
    the running revenue."""
    o = orders.where(F.col("order_date").isNotNull())
    if end is not None:
        # later orders only move interval ends beyond the window
        o = o.where(F.col("order_date") <= date_lit(end))
    first_id_day = F.min(F.when(F.col("order_id").isNotNull(), F.col("order_date")))
    if not with_revenue:
        g = o.groupBy("customer_id").agg(
            F.array_sort(F.collect_set("order_date")).alias("d"), first_id_day.alias("e"))
        nxt = F.concat(F.slice("d", 2, F.greatest(F.size("d") - 1, F.lit(0))), F.array(F.lit(None).cast("date")))
        z = g.select("customer_id", "e", F.explode(F.arrays_zip(F.col("d").alias("o"), nxt.alias("nx"))).alias("z"))
        iv = z.select("customer_id", F.col("z.o").alias("o"), F.col("z.nx").alias("nx"), "e")
    else:
        days = o.groupBy("customer_id", "order_date").agg(
            F.count("order_id").alias("ids"), F.sum("order_amount").alias("rev"))
        w = Window.partitionBy("customer_id").orderBy("order_date")
        iv = days.select(
            "customer_id",
            F.col("order_date").alias("o"),
            F.lead("order_date").over(w).alias("nx"),
            F.min(F.when(F.col("ids") > 0, F.col("order_date"))).over(Window.partitionBy("customer_id")).alias("e"),
            F.sum("rev").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("revenue_to_date"),
        )
    iv = iv.where(F.col("e").isNotNull() & (F.col("nx").isNull() | (F.col("nx") > F.col("e"))))
    keys = list(by or [])
    if keys:
        # a master that lists a customer twice under the same keys counts it once
        iv = iv.join(attributes.select("customer_id", *keys).distinct(), "customer_id", "left")
    return iv


def _status_events(iv: DataFrame, th: StatusThresholds, keys: list[str]) -> DataFrame:
    """+1 / -1 per status sub-interval; built-in expressions only (one
    explode of six candidate events, invalid ones carry a NULL day)."""
    a1, b1 = int(th.active_days) + 1, int(th.at_risk_days) + 1
    o, nx, e = F.col("o"), F.col("nx"), F.col("e")

    def least_nx(x):
        return F.when(nx.isNull(), x).otherwise(F.least(x, nx))

    events = []
    for status, lo, hi in (
        (ACTIVE, o, least_nx(F.date_add(o, a1))),
        (AT_RISK, F.date_add(o, a1), least_nx(F.date_add(o, b1))),
        (INACTIVE, F.date_add(o, b1), nx),
    ):
        lo = F.greatest(lo, e)
        ok = hi.isNull() | (lo < hi)
        events.append(F.struct(F.lit(status).alias("st"), F.when(ok, lo).alias("day"), F.lit(1).alias("delta")))
        events.append(F.struct(F.lit(status).alias("st"), F.when(ok, hi).alias("day"), F.lit(-1).alias("delta")))
    return (
        iv.select(*keys, F.explode(F.array(*events)).alias("ev"))
        .where(F.col("ev.day").isNotNull())
        .select(*keys, F.col("ev.st").alias("retention_status"), F.col("ev.day").alias("day"),
                F.col("ev.delta").alias("delta"))
    )


def customer_status_on_dates(intervals: DataFrame, dates: DataFrame,
                             thresholds: StatusThresholds = StatusThresholds(),
                             by: list[str] | None = None) -> DataFrame:
    """Customer-level as-of status on each date of ``dates`` (column
    ``snapshot_date``): every customer's distinct-order-day interval
    ``[o, nx)`` containing the date gives its last order day, hence its
    status, without computing facts once per date. ``intervals`` from
    ``order_day_intervals`` (with ``with_revenue=True`` the revenue to date
    is returned as ``total_revenue``). Other columns of ``dates`` are kept;
    ``by`` names those that the intervals have too and that must agree.

    The dates come as one array (per scope ``by``: an equi-join on the scope),
    at most a row per calendar day; each interval lists those that lie in it.
    For all days of a long window, ``runs.daily_snapshots`` needs no dates."""
    from cohortwise.functions.dates import day_diff
    from cohortwise.operators.status import status_expr

    keys = list(by or [])
    keep = [c for c in dates.columns if c != "snapshot_date"]
    entry = F.collect_list(F.struct("snapshot_date", *[c for c in keep if c not in keys]))
    if keys:
        listed = dates.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys]).agg(entry.alias("_dates"))
        iv = intervals.join(listed, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys])
    else:
        iv = intervals.withColumn("_dates", dates.agg(entry.alias("_dates")).scalar())
    low, nx = F.greatest("o", "e"), F.col("nx")
    within = F.filter("_dates", lambda x: (x["snapshot_date"] >= low) & (nx.isNull() | (x["snapshot_date"] < nx)))
    extra = ["revenue_to_date"] if "revenue_to_date" in intervals.columns else []
    j = iv.select("customer_id", "o", *keys, *extra, F.explode(within).alias("_at")).select(
        "customer_id", "o", *keys, *extra, "_at.*")
    days = day_diff("o", "snapshot_date")
    return j.select(
        "snapshot_date", *keep, "customer_id", F.col("o").alias("last_order_date"), days.alias("days_since_last_order"),
        status_expr(days, thresholds.active_days, thresholds.at_risk_days).alias("retention_status"),
        *[F.col(c).alias("total_revenue") for c in extra],
    )


def calendar(spark, start, end) -> DataFrame:
    """Every day in [start, end] (rows = days in the window)."""
    return spark.range(1).select(
        F.explode(F.sequence(date_lit(start), date_lit(end), F.expr("INTERVAL 1 DAY"))).alias("snapshot_date")
    )


def status_history(
    orders: DataFrame | None,
    start,
    end,
    thresholds: StatusThresholds = StatusThresholds(),
    dense: bool = False,
    attributes: DataFrame | None = None,
    by: list[str] | None = None,
    intervals: DataFrame | None = None,
) -> DataFrame:
    """Daily customers per status on every day of [start, end], as-of.

    ``dense=False`` (literal GROUP BY) emits no row for a status with no
    customer that day; ``dense=True`` zero-fills every (day, status) of
    every scope. ``intervals`` (from ``order_day_intervals``) can be passed
    instead of ``orders`` to share them with another consumer.

    After the per-(scope, status, day) event sums, every scope gets a zero
    event for each status on ``start``; a running sum over the event days
    of each (scope, status) gives runs of constant count, and each run is
    expanded to its calendar days. Scopes come from the data itself (no
    second pass to list them), and nothing is joined against a calendar."""
    keys = list(by or [])
    iv = intervals if intervals is not None else order_day_intervals(orders, end, attributes, keys)
    ev = _status_events(iv, thresholds, keys)
    s, t = date_lit(start), date_lit(end)
    statuses = F.array(*[F.lit(x) for x in (ACTIVE, AT_RISK, INACTIVE)])
    if keys:
        # every scope present gets every status on the first day (zero delta):
        # three marks per customer, from its one interval holding the entry day
        entry = iv.where((F.col("o") <= F.col("e")) & (F.col("e") <= t))
        marks = entry.select(*keys, F.explode(statuses).alias("retention_status")).select(
            *keys, "retention_status", s.alias("day"), F.lit(0).alias("delta"))
    else:
        marks = _status_marks(iv.sparkSession, start)
    return _counts_by_day(ev, marks, keys, start, end, dense)


def _status_marks(spark, start) -> DataFrame:
    """A zero event of every status on the first day."""
    statuses = F.array(*[F.lit(x) for x in (ACTIVE, AT_RISK, INACTIVE)])
    return spark.range(1).select(F.explode(statuses).alias("retention_status"), date_lit(start).alias("day"), F.lit(0).alias("delta"))


def history_from_runs(runs: DataFrame, start, end, dense: bool = False) -> DataFrame:
    """The daily history of status (or risk) runs: +1 on the first day of a
    run, -1 on the day after its last."""
    from cohortwise.operators.runs import run_events

    return history_from_events(run_events(runs, ["retention_status"]), start, end, dense)


def history_from_events(events: DataFrame, start, end, dense: bool = False) -> DataFrame:
    """The daily history of events (``retention_status, day, delta``), such as
    a stored series of their daily sums."""
    return _counts_by_day(events.select("retention_status", "day", "delta"), _status_marks(events.sparkSession, start), [], start, end, dense)


def _counts_by_day(ev: DataFrame, marks: DataFrame, keys: list[str], start, end, dense: bool) -> DataFrame:
    s, t = date_lit(start), date_lit(end)
    # events before the window accumulate on its first day; after it, drop
    ev = ev.where(F.col("day") <= t).withColumn("day", F.greatest(F.col("day"), s))
    daily = ev.unionByName(marks).groupBy(*keys, "retention_status", "day").agg(F.sum("delta").alias("delta"))
    w = Window.partitionBy(*keys, "retention_status").orderBy("day")
    runs = daily.select(
        *keys, "retention_status", "day",
        F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long").alias("n"),
        F.coalesce(F.date_sub(F.lead("day").over(w), 1), t).alias("last_day"),
    )
    if not dense:
        runs = runs.where(F.col("n") > 0)
    counts = runs.select(
        *keys, "retention_status", "n",
        F.explode(F.sequence(F.col("day"), F.col("last_day"), F.expr("INTERVAL 1 DAY"))).alias("snapshot_date"),
    ).withColumnRenamed("n", "customer_count")
    tot = F.sum("customer_count").over(Window.partitionBy(*keys, "snapshot_date"))
    out = counts.withColumn("total_customers", tot.cast("long"))
    pct = F.round(
        F.col("customer_count").cast("double") * 100.0 / F.nullif(F.col("total_customers"), F.lit(0)).cast("double"), 2
    )
    return out.withColumn("status_pct", pct).select(*keys, *HISTORY_COLUMNS)


def snapshot_distribution(snapshot: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1 on stored snapshots (one or many ``snapshot_date``s): count, total
    and share per (date, status)."""
    keys = list(by or [])
    g = snapshot.groupBy(*keys, "snapshot_date", "retention_status").agg(
        F.count(F.lit(1)).alias("customer_count")
    )
    tot = F.sum("customer_count").over(Window.partitionBy(*keys, "snapshot_date"))
    g = g.withColumn("total_customers", tot.cast("long"))
    return g.withColumn(
        "status_pct", F.round(F.col("customer_count").cast("double") * 100.0 / F.col("total_customers").cast("double"), 2)
    ).select(*keys, *HISTORY_COLUMNS)
