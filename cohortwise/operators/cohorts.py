"""Layer 4 — cohort retention (cohort month x months since acquisition).

Plan shape (one shuffle of ``orders``): group orders by customer and
collect the customer's distinct active months. ``collect_set`` is a
partial aggregate, so a hot customer is reduced on the map side and its
buffer is bounded by the number of calendar months, not by its orders.
The cohort month is the earliest active month (= month of the first
order, the facts' definition); exploding the months gives one activity row
per (customer, month) and the count per (cohort, offset) is a second,
tiny, partially-aggregated shuffle. The cohort size is the M+0 count: every
customer is active in its own cohort month, so no second pass over the
customers and no join is needed.

Money variants (revenue, LTV) first reduce orders to one row per
(customer, month) — spreading a hot customer by month — and then collect
those rows per customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.functions.dates import month_diff, month_start
from cohortwise.functions.numeric import share_pct

COHORT_COLUMNS = [
    "cohort_month",
    "months_since_acquisition",
    "cohort_size",
    "active_customers",
    "retention_rate",
]


def customer_months(orders: DataFrame) -> DataFrame:
    """H1 + H2 per customer: ``customer_id, cohort_month, months`` (array of
    distinct active months). Customers without an order id or without any
    dated order are not customers (the facts' filter); a NULL customer id
    never reaches a cohort (inner-join semantics)."""
    g = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.collect_set(month_start("order_date")).alias("months"),
            F.count("order_id").alias("_ids"),
        )
    )
    return g.where((F.col("_ids") > 0) & (F.size("months") > 0)).select(
        "customer_id", F.array_min("months").alias("cohort_month"), "months"
    )


def _with_size_and_rate(agg: DataFrame, keys: list[str], max_months: int | None,
                        extra: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(*keys, "cohort_month")
    size = F.max(F.when(F.col("months_since_acquisition") == 0, F.col("active_customers"))).over(w)
    out = agg.withColumn("cohort_size", size.cast("long"))
    if max_months is not None:
        out = out.where(F.col("months_since_acquisition") <= int(max_months))
    out = out.withColumn("retention_rate", share_pct("active_customers", "cohort_size", 2))
    return out.select(*keys, *COHORT_COLUMNS, *(extra or []))


def cohort_retention(
    orders: DataFrame | None,
    max_months: int | None = None,
    attributes: DataFrame | None = None,
    by: list[str] | None = None,
    months: DataFrame | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """H1-H6 (+P6 frozen window, +X6 extra keys). ``by`` columns come from
    ``attributes`` (e.g. the customers master; rows that repeat a customer
    and its keys count once), joined after the per-customer reduction.
    ``months`` (``customer_id, cohort_month, months``, e.g. from the
    customer profile) replaces the reduction of ``orders``.

    With ``facts`` (a layer 1 table, which then also supplies ``by``) cohort
    month and cohort size are taken from the facts and only the activity from
    ``orders``, so a cohort can show that the two layers disagree."""
    keys = list(by or [])
    if facts is not None:
        return _retention_from_facts(orders, facts, keys, max_months)
    cm = months if months is not None else customer_months(orders)
    if keys:
        attrs = attributes.select("customer_id", *keys).distinct()
        cm = cm.join(attrs, "customer_id", "left")
    act = cm.select(*keys, "cohort_month", F.explode("months").alias("activity_month")).select(
        *keys, "cohort_month", month_diff("cohort_month", "activity_month").alias("months_since_acquisition")
    )
    agg = (
        act.where(F.col("months_since_acquisition") >= 0)
        .groupBy(*keys, "cohort_month", "months_since_acquisition")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    return _with_size_and_rate(agg, keys, max_months).orderBy(*keys, "cohort_month", "months_since_acquisition")


def _retention_from_facts(orders: DataFrame, facts: DataFrame, keys: list[str], max_months: int | None) -> DataFrame:
    """Sizes are distinct customers of the facts, activity distinct customers
    with an order in the month; joined per customer and per cohort."""
    assigned = facts.where(F.col("customer_id").isNotNull() & F.col("first_order_date").isNotNull()).select(
        "customer_id", *keys, month_start("first_order_date").alias("cohort_month")).distinct()
    size = assigned.groupBy(*keys, "cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"))
    active = orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()).groupBy("customer_id").agg(
        F.collect_set(month_start("order_date")).alias("months"))
    act = assigned.join(active, "customer_id").select(
        "customer_id", *keys, "cohort_month", F.explode("months").alias("_month")).select(
        "customer_id", *keys, "cohort_month", month_diff("cohort_month", "_month").alias("months_since_acquisition"))
    agg = act.where(F.col("months_since_acquisition") >= 0).groupBy(*keys, "cohort_month", "months_since_acquisition").agg(
        F.count_distinct("customer_id").alias("active_customers"))
    if max_months is not None:
        agg = agg.where(F.col("months_since_acquisition") <= int(max_months))
    sized = size.select(*[F.col(k).alias(f"_s_{k}") for k in (*keys, "cohort_month")], "cohort_size")
    out = agg.join(sized, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in (*keys, "cohort_month")])
    out = out.withColumn("retention_rate", share_pct("active_customers", "cohort_size", 2))
    return out.select(*keys, *COHORT_COLUMNS).orderBy(*keys, "cohort_month", "months_since_acquisition")


def cohort_pivot(cohorts: DataFrame, max_months: int = 12) -> DataFrame:
    """X21 — wide heat-map table: one row per cohort, one column per
    maturity ``m00 .. mNN`` (explicit pivot values, no extra distinct job)."""
    values = list(range(0, int(max_months) + 1))
    p = (
        cohorts.where(F.col("months_since_acquisition") <= int(max_months))
        .groupBy("cohort_month", "cohort_size")
        .pivot("months_since_acquisition", values)
        .agg(F.first("retention_rate"))
    )
    return p.select("cohort_month", "cohort_size", *[F.col(str(v)).alias(f"m{v:02d}") for v in values])


def cohort_revenue(orders: DataFrame, max_months: int | None = None, money_digits: int = 2) -> DataFrame:
    """X4 — cohort table plus ``cohort_revenue`` (rounded to ``money_digits``,
    cents by default, so partial-sum order cannot show) and
    ``revenue_per_customer`` (the rounded revenue over the cohort size, so it
    is deterministic too) per (cohort, offset)."""
    cm = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", month_start("order_date").alias("activity_month"))
        .agg(F.sum("order_amount").alias("rev"), F.count("order_id").alias("_ids"))
    )
    # one row per customer with its (month, revenue) pairs: bounded by calendar months
    per_c = (
        cm.groupBy("customer_id")
        .agg(
            F.min("activity_month").alias("cohort_month"),
            F.collect_list(F.struct("activity_month", "rev")).alias("m"),
            F.sum("_ids").alias("_ids"),
        )
        .where((F.col("_ids") > 0) & F.col("cohort_month").isNotNull())
    )
    act = per_c.select("cohort_month", F.explode("m").alias("x")).select(
        "cohort_month",
        month_diff("cohort_month", "x.activity_month").alias("months_since_acquisition"),
        F.col("x.rev").alias("rev"),
    )
    agg = (
        act.where(F.col("months_since_acquisition") >= 0)
        .groupBy("cohort_month", "months_since_acquisition")
        .agg(F.count(F.lit(1)).alias("active_customers"), F.sum("rev").alias("cohort_revenue"))
    )
    agg = agg.withColumn("cohort_revenue", F.round("cohort_revenue", int(money_digits)))
    out = _with_size_and_rate(agg, [], max_months, ["cohort_revenue"])
    return out.withColumn(
        "revenue_per_customer", F.col("cohort_revenue") / F.col("cohort_size").cast("double")
    )


def cohort_ltv(revenue: DataFrame, horizon_month=None, money_digits: int = 2) -> DataFrame:
    """X5 — cumulative revenue per acquired customer on a dense month axis
    ``0 .. months up to horizon_month`` (default: the latest active month in
    the data). The axis has cohorts x months rows (calendar-bounded)."""
    sizes = revenue.select("cohort_month", "cohort_size", F.add_months(
        "cohort_month", F.col("months_since_acquisition").cast("int")).alias("_active")).groupBy(
        "cohort_month", "cohort_size").agg(F.max("_active").alias("_last"))
    if horizon_month is None:
        # latest active month over all cohorts: a window over cohorts (one row each)
        h = F.max("_last").over(Window.partitionBy())
    else:
        from cohortwise.functions.dates import date_lit

        h = month_start(date_lit(horizon_month))
    axis = sizes.withColumn("_h", h).select(
        "cohort_month",
        "cohort_size",
        F.explode(F.sequence(F.lit(0).cast("long"), month_diff("cohort_month", "_h"))).alias("months_since_acquisition"),
    )
    rev = revenue.select("cohort_month", "months_since_acquisition", "cohort_revenue")
    dense = axis.join(rev, ["cohort_month", "months_since_acquisition"], "left").fillna(0.0, ["cohort_revenue"])
    w = Window.partitionBy("cohort_month").orderBy("months_since_acquisition").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cum = F.round(F.sum("cohort_revenue").over(w), int(money_digits))
    return dense.select(
        "cohort_month",
        "months_since_acquisition",
        "cohort_size",
        "cohort_revenue",
        cum.alias("cumulative_revenue"),
        (cum / F.col("cohort_size").cast("double")).alias("ltv_per_customer"),
    )


def cohort_compare(cohorts: DataFrame, maturities=(3, 6)) -> DataFrame:
    """X17 — every cohort at the same maturity against the previous cohort
    that reached it: PASS when its rate is not lower, FAIL otherwise,
    NO_BASELINE for the first cohort."""
    m = cohorts.where(F.col("months_since_acquisition").isin([int(x) for x in maturities]))
    w = Window.partitionBy("months_since_acquisition").orderBy("cohort_month")
    prev = F.lag("retention_rate").over(w)
    out = m.select(
        "months_since_acquisition",
        "cohort_month",
        "retention_rate",
        prev.alias("previous_rate"),
        F.lag("cohort_month").over(w).alias("previous_cohort"),
    )
    return out.withColumn(
        "rate_change", F.round(F.col("retention_rate") - F.col("previous_rate"), 2)
    ).withColumn(
        "verdict",
        F.when(F.col("previous_rate").isNull(), F.lit("NO_BASELINE"))
        .when(F.col("retention_rate") >= F.col("previous_rate"), F.lit("PASS"))
        .otherwise(F.lit("FAIL")),
    )


def forecast(cohorts: DataFrame, plan: DataFrame, aov: float | None = None, orders: DataFrame | None = None,
             max_months: int | None = None, latest_cohorts: int | None = None, weighted: bool = False) -> DataFrame:
    """X18 (our reading of an outlined use case) — expected revenue of
    planned acquisitions: average retention curve by maturity x planned new
    customers x average order value, per scenario multiplier. The curve is
    the mean over all cohorts, or over the ``latest_cohorts`` that reached
    the maturity; ``weighted``: by cohort size. ``max_months`` ends it.

    ``plan``: ``plan_month DATE, new_customers LONG, scenario STRING,
    multiplier DOUBLE`` (caller input, one row per month and scenario).
    ``aov`` defaults to the mean order amount over ``orders``."""
    if max_months is not None:
        cohorts = cohorts.where(F.col("months_since_acquisition") <= int(max_months))
    if latest_cohorts is not None:  # one row per cohort month in each window
        newest = Window.partitionBy("months_since_acquisition").orderBy(F.desc("cohort_month"))
        cohorts = cohorts.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= int(latest_cohorts))
    mean = (F.sum(F.col("retention_rate") * F.col("cohort_size")) / F.sum("cohort_size")) if weighted else F.avg("retention_rate")
    curve = cohorts.groupBy("months_since_acquisition").agg(F.round(mean, 6).alias("avg_retention_rate"))
    # means kept to 6 digits so the forecast does not depend on summation order
    if aov is None:
        aov_df = orders.agg(F.round(F.avg("order_amount"), 6).alias("aov"))
    else:
        aov_df = cohorts.sparkSession.range(1).select(F.lit(float(aov)).alias("aov"))
    # plan rows x curve rows: both bounded by configuration / calendar months
    j = plan.crossJoin(curve).crossJoin(aov_df)
    rate = F.least(F.col("avg_retention_rate") * F.col("multiplier"), F.lit(100.0)) / 100.0
    return j.select(
        "scenario",
        "plan_month",
        "months_since_acquisition",
        F.add_months("plan_month", F.col("months_since_acquisition").cast("int")).alias("revenue_month"),
        (F.col("new_customers") * rate).alias("expected_active"),
        (F.col("new_customers") * rate * F.col("aov")).alias("expected_revenue"),
    )
