"""One per-customer profile feeding every layer.

The layers each reduce ``orders`` by customer. When several run together
(the daily refresh), the orders table is shuffled once into a profile row
per customer that carries the facts *and* the customer's distinct order
days; status, risk, cohorts and the daily history are then narrow
transformations of the profile (plus small aggregations), so the largest
table is scanned and shuffled once per refresh instead of once per layer.

The order-days array of a customer is bounded by calendar days, whatever
the customer's number of orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.dates import date_lit, month_start
from cohortwise.operators.facts import FACT_COLUMNS, customer_attributes

PROFILE_EXTRA = ["order_days", "entry_day", "amount_rows"]


def customer_profile(orders: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """Facts columns + ``order_days`` (sorted distinct order days) +
    ``entry_day`` (first day with an order id) + ``amount_rows`` (non-NULL
    amounts, so the average can be merged incrementally). Customers whose facts
    would be filtered (no order id or no dated order) are kept here with
    ``total_orders = 0`` or NULL dates; ``facts_from_profile`` applies the
    facts filter."""
    o = orders if as_of is None else orders.where(F.col("order_date") <= date_lit(as_of))
    agg = o.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("order_amount").alias("total_revenue"),
        F.avg("order_amount").alias("avg_order_value"),
        F.array_sort(F.collect_set("order_date")).alias("order_days"),
        F.min(F.when(F.col("order_id").isNotNull(), F.col("order_date"))).alias("entry_day"),
        F.count("order_amount").alias("amount_rows"),
    )
    return agg.join(customer_attributes(customers), "customer_id", "left").select(*FACT_COLUMNS, *PROFILE_EXTRA)


def facts_from_profile(profile: DataFrame) -> DataFrame:
    return profile.where((F.col("total_orders") >= 1) & F.col("first_order_date").isNotNull()).select(*FACT_COLUMNS)


def intervals_from_profile(profile: DataFrame) -> DataFrame:
    """The history's ``(customer_id, o, nx, e)`` rows (see
    ``history.order_day_intervals``) without touching orders."""
    d = F.col("order_days")
    nxt = F.concat(F.slice(d, 2, F.greatest(F.size(d) - 1, F.lit(0))), F.array(F.lit(None).cast("date")))
    z = profile.where(F.col("entry_day").isNotNull()).select(
        "customer_id", F.col("entry_day").alias("e"), F.explode(F.arrays_zip(d.alias("o"), nxt.alias("nx"))).alias("z"))
    return z.select("customer_id", F.col("z.o").alias("o"), F.col("z.nx").alias("nx"), "e").where(
        F.col("nx").isNull() | (F.col("nx") > F.col("e")))


def customer_months_from_profile(profile: DataFrame) -> DataFrame:
    """The cohorts' ``(customer_id, cohort_month, months)`` rows."""
    p = profile.where(F.col("customer_id").isNotNull() & (F.col("total_orders") >= 1)
                      & F.col("first_order_date").isNotNull())
    months = F.array_distinct(F.transform("order_days", lambda x: month_start(x)))
    return p.select("customer_id", month_start("first_order_date").alias("cohort_month"), months.alias("months"))
