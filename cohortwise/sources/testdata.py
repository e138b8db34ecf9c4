"""Adapters from the parquet test tables to the logical relations.

Logical ``orders``:    customer_id BIGINT, order_id BIGINT, order_date DATE,
                       order_amount DOUBLE, order_status STRING
Logical ``customers``: customer_id BIGINT, customer_email STRING, country STRING,
                       customer_segment STRING, acquisition_channel STRING,
                       signup_date DATE

Every adapter is a ``select`` over a parquet scan, so Catalyst prunes the
scan to the columns a query uses and pushes date / status predicates
(``as_of``, ``accepted_statuses``) into the parquet reader. Columns that the
test tables do not have become typed NULLs; nothing is invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.dates import date_lit


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cut(df: DataFrame, as_of, date_col: str = "order_date") -> DataFrame:
    return df if as_of is None else df.where(F.col(date_col) <= date_lit(as_of))


def orders(
    spark: SparkSession,
    sf_dir: str,
    accepted_statuses: list[str] | None = None,
    as_of=None,
) -> DataFrame:
    """``orders`` from the TPC-H-like table. ``accepted_statuses`` is the
    valid-order filter applied once, upstream of every layer, so facts and
    cohorts see the same orders. ``as_of`` cuts orders after that date."""
    o = read_table(spark, sf_dir, "orders")
    if accepted_statuses is not None:
        o = o.where(F.col("o_orderstatus").isin(list(accepted_statuses)))
    df = o.select(
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("double").alias("order_amount"),
        F.col("o_orderstatus").alias("order_status"),
    )
    return _cut(df, as_of)


def event_purchases(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    """Second order source: ``events`` rows of type ``purchase``."""
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    df = e.select(
        F.col("user_id").cast("long").alias("customer_id"),
        F.col("event_id").cast("long").alias("order_id"),
        F.to_date("ts").alias("order_date"),
        F.col("value").cast("double").alias("order_amount"),
        F.lit(None).cast("string").alias("order_status"),
    )
    return _cut(df, as_of)


def engagement_events(spark: SparkSession, sf_dir: str, as_of=None) -> DataFrame:
    """Non-purchase activity (view, click, signup, error) per customer and day."""
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") != "purchase")
    df = e.select(
        F.col("user_id").cast("long").alias("customer_id"),
        F.to_date("ts").alias("event_date"),
        F.col("event_type"),
    )
    return _cut(df, as_of, "event_date")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers`` master data. ``country`` comes from ``nation`` (a
    dimension bounded by the number of countries; Spark's size-checked
    broadcast threshold decides the join strategy)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name")
    )
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        F.lit(None).cast("string").alias("customer_email"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(None).cast("string").alias("acquisition_channel"),
        F.lit(None).cast("date").alias("signup_date"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions read off the orders: each customer's latest order runs for
    twelve months (``renewal_date``); if that order was fulfilled, the
    subscription was cancelled 60 days after it (``cancelled_at``)."""
    last = orders(spark, sf_dir).groupBy("customer_id").agg(
        F.max(F.struct("order_date", "order_id", "order_status")).alias("last"))
    return last.select(
        "customer_id", F.add_months("last.order_date", 12).alias("renewal_date"),
        F.when(F.col("last.order_status") == "F", F.date_add("last.order_date", 60)).alias("cancelled_at"))
