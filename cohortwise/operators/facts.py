"""Layer 1 — per-customer purchase facts (one row per customer).

Plan shape: one hash aggregation of ``orders`` by ``customer_id``. The
``COUNT(DISTINCT order_id)`` is planned by Catalyst as a two-level
aggregation (first on ``(customer_id, order_id)``, then on ``customer_id``),
so a hot customer is spread over the order ids before it is reduced and
only one partial row per map task reaches the final reducer. The master
data join is a left equi-join on the (already hash-partitioned) key; AQE
turns it into a broadcast when the master side is small at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.dates import date_lit

FACT_COLUMNS = [
    "customer_id",
    "customer_email",
    "country",
    "customer_segment",
    "acquisition_channel",
    "signup_date",
    "first_order_date",
    "last_order_date",
    "total_orders",
    "total_revenue",
    "avg_order_value",
]

ATTRIBUTE_COLUMNS = FACT_COLUMNS[1:6]


def order_aggregates(orders: DataFrame, as_of=None, with_last_order_value: bool = False) -> DataFrame:
    """F1 — MIN/MAX date, distinct orders, revenue sum and mean per customer.

    ``as_of`` keeps only orders on or before that date (replay of a past
    day); ``None`` is the literal behaviour (all orders).
    ``with_last_order_value`` adds the amount of the latest order, ties on
    the date broken by the highest ``order_id`` (no join back to orders)."""
    o = orders if as_of is None else orders.where(F.col("order_date") <= date_lit(as_of))
    aggs = [
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("order_amount").alias("total_revenue"),
        F.avg("order_amount").alias("avg_order_value"),
    ]
    if with_last_order_value:
        aggs.append(
            F.max_by("order_amount", F.struct("order_date", "order_id")).alias("last_order_value")
        )
    return o.groupBy("customer_id").agg(*aggs)


def customer_attributes(customers: DataFrame) -> DataFrame:
    """F2 — the six profile columns."""
    return customers.select("customer_id", *ATTRIBUTE_COLUMNS)


def base_customers(
    orders: DataFrame,
    customers: DataFrame,
    as_of=None,
    with_last_order_value: bool = False,
) -> DataFrame:
    """F3 — facts: aggregates LEFT JOIN attributes, customers with >= 1 order."""
    agg = order_aggregates(orders, as_of, with_last_order_value).where(
        (F.col("total_orders") >= 1) & F.col("first_order_date").isNotNull()
    )
    out = agg.join(customer_attributes(customers), "customer_id", "left")
    cols = FACT_COLUMNS + (["last_order_value"] if with_last_order_value else [])
    return out.select(*cols)


def facts_on_dates(orders: DataFrame, dates: list) -> DataFrame:
    """The purchase columns of the facts as of each of a few ``dates``, from
    one pass over the orders: one row per (customer, ``snapshot_date``).

    Orders are first reduced per (customer, order id), with the first day of
    the order and, for each date, what it holds up to it; then per customer.
    Customers without an order id or a dated order by a date have no row for
    it. Profile attributes are not joined."""
    days = [date_lit(d) for d in dates]
    day, amount = F.col("order_date"), F.col("order_amount")

    def upto(i, value):
        return F.when(day <= days[i], value)

    per_order = orders.groupBy("customer_id", "order_id").agg(*[x for i in range(len(days)) for x in (
        F.min(upto(i, day)).alias(f"first{i}"), F.max(upto(i, day)).alias(f"last{i}"),
        F.sum(upto(i, amount)).alias(f"revenue{i}"), F.count(upto(i, amount)).alias(f"amounts{i}"))])
    per_customer = per_order.groupBy("customer_id").agg(*[x for i in range(len(days)) for x in (
        F.min(f"first{i}").alias(f"first{i}"), F.max(f"last{i}").alias(f"last{i}"),
        F.count(F.when(F.col(f"first{i}").isNotNull(), F.col("order_id"))).alias(f"orders{i}"),
        F.sum(f"revenue{i}").alias(f"revenue{i}"), F.sum(f"amounts{i}").alias(f"amounts{i}"))])
    rows = per_customer.select("customer_id", F.explode(F.array(*[F.struct(
        days[i].alias("snapshot_date"), F.col(f"first{i}").alias("first_order_date"), F.col(f"last{i}").alias("last_order_date"),
        F.col(f"orders{i}").alias("total_orders"), F.col(f"revenue{i}").alias("total_revenue"),
        F.when(F.col(f"amounts{i}") > 0, F.col(f"revenue{i}") / F.col(f"amounts{i}")).alias("avg_order_value"))
        for i in range(len(days))])).alias("f")).select("customer_id", "f.*")
    return rows.where((F.col("total_orders") >= 1) & F.col("first_order_date").isNotNull())
