"""X23 — incremental facts refresh ("only new / updated customers").

``COUNT(DISTINCT order_id)`` and ``AVG`` do not merge from stored
aggregates (a late duplicate of an order changes the sum but not the
count), so the exact incremental path recomputes the *touched* customers
only: customers of the new batch are re-aggregated from all their orders
(a semi join on ``customer_id``), the other stored fact rows are kept
(anti join), and the two are unioned. The result equals a full rebuild.

The NULL customer id is a real fact row (GROUP BY keeps it), so both joins
use null-safe equality.

Streaming: ``start_facts_refresh`` reads new order files with
``readStream`` and applies the same merge in ``foreachBatch``. Every epoch
merges into the newest state *before* it and publishes itself last (see
``versions``), so an epoch that runs again gives the same table.

Without re-reading orders: ``merge_profile`` keeps the customer profile
(facts + order days + amount row count) and a ledger of counted
``(customer_id, order_id)`` pairs; a batch adds only its unseen pairs to
the distinct count and merges everything else directly. In its streaming
form, ``start_profile_refresh``, the profile lies in buckets of customers of
which an epoch rewrites those it touches, and the ledger is append-only: an
epoch adds the pairs it counted, in the same buckets.

The daily status history can be kept along (``series=``): a stored series of
signed events, summed per (status, day). A late order splits an interval that
was counted already, so an epoch retracts the events of its customers as they
were before, with the opposite sign, and adds those of the merged profile.
Customers that the batch does not name are not read for it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.config import StatusThresholds
from cohortwise.operators.facts import FACT_COLUMNS, base_customers
from cohortwise.session import checkpoint_dir
from cohortwise.streaming.versions import VersionedTable

#: Customers of the first batch per bucket of a profile; a bucket is the unit that an epoch reads and rewrites.
CUSTOMERS_PER_BUCKET = 250_000


def _touched(new_orders: DataFrame) -> DataFrame:
    return new_orders.select(F.col("customer_id").alias("_cid")).distinct()


def incremental_facts(previous: DataFrame, all_orders: DataFrame, new_orders: DataFrame,
                      customers: DataFrame) -> DataFrame:
    """Facts after a batch of ``new_orders`` (already part of ``all_orders``)."""
    touched = _touched(new_orders)
    mine = all_orders.join(touched, all_orders["customer_id"].eqNullSafe(touched["_cid"]), "left_semi")
    recomputed = base_customers(mine, customers)
    kept = previous.join(touched, previous["customer_id"].eqNullSafe(touched["_cid"]), "left_anti")
    return kept.select(*FACT_COLUMNS).unionByName(recomputed.select(*FACT_COLUMNS))


def read_facts_version(spark: SparkSession, table: str) -> DataFrame:
    """The newest published facts of a streaming refresh."""
    return spark.read.parquet(*VersionedTable(spark, table).newest("facts"))


def merge_facts_epoch(spark: SparkSession, table: str, epoch_id: int, new_orders: DataFrame, all_orders: DataFrame | None,
                      customers: DataFrame) -> None:
    """Merges one batch into the facts as published before ``epoch_id``.

    Without ``all_orders`` the table keeps the orders itself, in buckets of
    customers: the epoch stores its batch and reads the touched buckets of the
    epochs up to its own, so that it gives the same table whenever it runs."""
    versions = VersionedTable(spark, table)
    versions.begin(epoch_id)
    base = versions.newest("facts", before=epoch_id)
    if all_orders is None:
        buckets, touched = _buckets(versions, new_orders, None)
        kept = new_orders.withColumn("bucket", bucket_of("customer_id", buckets)).repartition("bucket")
        versions.write(kept, "orders", epoch_id, "bucket")
        new_orders = spark.read.schema(new_orders.schema).parquet(*versions.parts_of("orders", epoch_id, touched))
        earlier = versions.all_parts("orders", before=epoch_id, buckets=touched)
        all_orders = new_orders.unionByName(spark.read.schema(new_orders.schema).parquet(*earlier)) if earlier else new_orders
    if base:
        facts = incremental_facts(spark.read.parquet(*base), all_orders, new_orders, customers)
    else:
        facts = base_customers(all_orders, customers)
    versions.write(facts, "facts", epoch_id)
    versions.publish(epoch_id)
    versions.expire("facts")


def start_facts_refresh(spark: SparkSession, orders_dir: str, orders_schema, to_orders, customers: DataFrame,
                        table: str, checkpoint: str | None = None, trigger_once: bool = True):
    """Stream new order files from ``orders_dir`` into the versioned facts
    ``table``. ``to_orders`` maps a raw DataFrame (file rows) to the logical
    orders relation (e.g. the test-data adapter's select)."""
    checkpoint = checkpoint or _default_checkpoint(spark, table)
    VersionedTable(spark, table).refuse_fresh_checkpoint(checkpoint)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_facts_epoch(spark, table, epoch_id, to_orders(batch), None, customers)

    stream = spark.readStream.schema(orders_schema).parquet(orders_dir)
    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def _default_checkpoint(spark: SparkSession, table: str) -> str:
    """A folder of the cluster's checkpoint folder that belongs to the table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/refresh-{hashlib.sha256(table.encode()).hexdigest()[:16]}"


# ---------------------------------------------------------------------------
# Exact merge without re-reading orders: profile + order-id ledger
# ---------------------------------------------------------------------------
def merge_profile(previous: DataFrame, ledger: DataFrame, batch: DataFrame,
                  customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge a batch of order rows into the customer profile.

    ``ledger`` holds the distinct ``(customer_id, order_id)`` pairs already
    counted; only the batch's pairs missing from it add to
    ``total_orders`` (an anti join keyed by the pair, so a hot customer is
    spread over its order ids). MIN / MAX / SUM / row counts merge directly
    (a re-delivered order row adds to revenue exactly as it would in a full
    rebuild over all rows), the order-day arrays are unioned, and the
    average is recomputed from the merged sum and row count. Returns the
    profile, equal to a rebuild from all orders, and the pairs to append to
    the ledger."""
    from cohortwise.operators.profile import PROFILE_EXTRA

    # explicit column names on every side: all inputs derive from the same
    # orders, so DataFrame-bound column references would be ambiguous
    pairs = batch.where(F.col("order_id").isNotNull()).select(
        F.col("customer_id").alias("_pc"), F.col("order_id").alias("_po")).distinct()
    seen = ledger.select(F.col("customer_id").alias("_lc"), F.col("order_id").alias("_lo"))
    fresh = pairs.join(seen, F.col("_pc").eqNullSafe(F.col("_lc")) & (F.col("_po") == F.col("_lo")), "left_anti")
    new_ids = fresh.groupBy(F.col("_pc").alias("_nc")).agg(F.count(F.lit(1)).alias("_new_ids"))
    b = batch.groupBy(F.col("customer_id").alias("_bc")).agg(
        F.min("order_date").alias("_first"), F.max("order_date").alias("_last"),
        F.sum("order_amount").alias("_rev"), F.count("order_amount").alias("_rows"),
        F.array_sort(F.collect_set("order_date")).alias("_days"),
        F.min(F.when(F.col("order_id").isNotNull(), F.col("order_date"))).alias("_entry"),
    )
    b = b.join(new_ids, F.col("_bc").eqNullSafe(F.col("_nc")), "left")
    p = previous.select(F.col("customer_id").alias("_oc"), "first_order_date", "last_order_date", "total_orders",
                        "total_revenue", "order_days", "entry_day", "amount_rows")
    j = p.join(b, F.col("_oc").eqNullSafe(F.col("_bc")), "full")
    cid = F.coalesce(F.col("_oc"), F.col("_bc")).alias("customer_id")

    def add(x, y):
        return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(x + y)

    rev = add(F.col("total_revenue"), F.col("_rev"))
    rows = F.coalesce(F.col("amount_rows"), F.lit(0)) + F.coalesce(F.col("_rows"), F.lit(0))
    merged = j.select(
        cid,
        F.least("first_order_date", "_first").alias("first_order_date"),
        F.greatest("last_order_date", "_last").alias("last_order_date"),
        (F.coalesce(F.col("total_orders"), F.lit(0)) + F.coalesce(F.col("_new_ids"), F.lit(0))).cast("long")
        .alias("total_orders"),
        rev.alias("total_revenue"),
        F.when(rows > 0, rev / rows.cast("double")).alias("avg_order_value"),
        F.array_sort(F.array_union(F.coalesce("order_days", F.array().cast("array<date>")),
                                   F.coalesce("_days", F.array().cast("array<date>")))).alias("order_days"),
        F.least("entry_day", "_entry").alias("entry_day"),
        rows.cast("long").alias("amount_rows"),
    )
    from cohortwise.operators.facts import customer_attributes

    profile = merged.join(customer_attributes(customers), "customer_id", "left").select(*FACT_COLUMNS, *PROFILE_EXTRA)
    return profile, fresh.select(F.col("_pc").alias("customer_id"), F.col("_po").alias("order_id"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "customer_id long, order_id long")


def bucket_of(customer_id, buckets: int):
    return F.pmod(F.xxhash64(customer_id), F.lit(int(buckets))).cast("int")


def _buckets(versions: VersionedTable, batch: DataFrame, buckets: int | None) -> tuple[int, list[int]]:
    """(buckets of the table, those that hold a customer of the batch). The
    first epoch fixes the number: the caller's, or one by its customers."""
    known = versions.setting("buckets")
    if known is not None and buckets is not None and int(known) != buckets:
        raise ValueError(f"{versions.path} has {known} buckets, not {buckets}")
    if known is None:
        if buckets is None:
            customers = batch.agg(F.approx_count_distinct("customer_id").alias("n")).first()["n"]
            buckets = max(-(-customers // CUSTOMERS_PER_BUCKET), 1)
        versions.set_setting("buckets", buckets)
    count = int(known) if known is not None else buckets
    touched = batch.select(bucket_of("customer_id", count).alias("b")).distinct().collect()  # at most ``count`` numbers
    return count, sorted(r["b"] for r in touched)


def read_profile_version(spark: SparkSession, table: str) -> DataFrame:
    """The newest published profile of a streaming refresh."""
    return spark.read.parquet(*VersionedTable(spark, table).newest("profile"))


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """All (customer, order) pairs counted by published epochs."""
    paths = VersionedTable(spark, table).all_parts("ledger")
    return spark.read.parquet(*paths).select("customer_id", "order_id") if paths else empty_ledger(spark)


def status_events(profile: DataFrame, thresholds: StatusThresholds) -> DataFrame:
    """Signed status events (``retention_status, day, delta``) of a profile."""
    from cohortwise.operators.profile import intervals_from_profile
    from cohortwise.operators.runs import run_events, status_runs

    return run_events(status_runs(intervals_from_profile(profile), thresholds), ["retention_status"])


def _summed(events: DataFrame) -> DataFrame:
    return events.groupBy("retention_status", "day").agg(F.sum("delta").cast("long").alias("delta")).where(F.col("delta") != 0)


def read_daily_history(spark: SparkSession, table: str, start, end, dense: bool = False) -> DataFrame:
    """The daily status history from the newest stored series: a few rows per
    day are read, no customers."""
    from cohortwise.operators.history import history_from_events

    return history_from_events(spark.read.parquet(*VersionedTable(spark, table).newest("series")), start, end, dense)


def merge_profile_epoch(spark: SparkSession, table: str, epoch_id: int, new_orders: DataFrame, customers: DataFrame,
                        buckets: int | None = None, series: StatusThresholds | None = None, fail_after: str | None = None) -> None:
    """Merges one batch into the profile and ledger as published before
    ``epoch_id``. Only buckets that hold a customer of the batch are read and
    written. ``buckets`` is fixed by a table's first epoch (None: by its
    number of customers). ``series``: the thresholds of a daily history kept
    along, the same for the life of the table; begun on a table that has
    epochs without one, it is summed up once from the whole profile.
    ``fail_after`` ("ledger", "profile" or "series") breaks off there, for
    tests of recovery."""
    from cohortwise.operators.profile import customer_profile

    versions = VersionedTable(spark, table)
    versions.begin(epoch_id)
    count, touched = _buckets(versions, new_orders, buckets)
    names = {f"bucket={b}" for b in touched}
    whole = versions.newest("profile", before=epoch_id)
    base = [p for p in whole if p.rsplit("/", 1)[1] in names]
    counted = versions.all_parts("ledger", before=epoch_id, buckets=touched)
    previous = spark.read.parquet(*base) if base else customer_profile(new_orders.limit(0), customers)
    ledger = spark.read.parquet(*counted) if counted else empty_ledger(spark)
    profile, fresh = merge_profile(previous, ledger, new_orders, customers)
    for name, df in (("ledger", fresh), ("profile", profile)):
        versions.write(df.withColumn("bucket", bucket_of("customer_id", count)).repartition("bucket"), name, epoch_id, "bucket")
        if fail_after == name:
            raise RuntimeError(f"broken off after {name}")
    if series is not None:
        versions.write(_merged_series(versions, epoch_id, new_orders, previous, whole, touched, series).coalesce(1), "series", epoch_id)
        if fail_after == "series":
            raise RuntimeError("broken off after series")
    versions.publish(epoch_id)
    versions.expire("profile")
    versions.expire("series")


def _merged_series(versions: VersionedTable, epoch_id: int, new_orders: DataFrame, previous: DataFrame, whole: list[str],
                   touched: list[int], thresholds: StatusThresholds) -> DataFrame:
    """The stored series with the events of the batch's customers retracted as
    they were and added as they are."""
    spark, name = versions.spark, f"{thresholds.active_days}-{thresholds.at_risk_days}"
    if (versions.setting("series") or name) != name:
        raise ValueError(f"{versions.path} keeps a series of {versions.setting('series')} days, not {name}")
    versions.set_setting("series", name)
    mine = new_orders.select(F.col("customer_id").alias("_mine")).distinct()

    def touched_events(profile: DataFrame) -> DataFrame:
        of_batch = profile.join(mine, profile["customer_id"].eqNullSafe(mine["_mine"]), "left_semi")
        return status_events(of_batch, thresholds)

    after = versions.parts_of("profile", epoch_id, touched)
    changes = touched_events(previous).withColumn("delta", -F.col("delta"))
    if after:  # an empty batch writes no bucket
        changes = changes.unionByName(touched_events(spark.read.parquet(*after)))
    stored = versions.newest("series", before=epoch_id)
    if stored:
        before = spark.read.parquet(*stored)
    elif whole:
        before = status_events(spark.read.parquet(*whole), thresholds)
    else:
        return _summed(changes)
    return _summed(before.select("retention_status", "day", "delta").unionByName(changes))


def start_profile_refresh(spark: SparkSession, orders_dir: str, orders_schema, to_orders, customers: DataFrame,
                          table: str, checkpoint: str | None = None, trigger_once: bool = True,
                          buckets: int | None = None, series: StatusThresholds | None = None):
    """Stream new order files into the versioned profile and ledger of
    ``table``, and into its daily ``series`` if asked for; a batch reads itself
    and the buckets it touches, never the order history."""
    checkpoint = checkpoint or _default_checkpoint(spark, table)
    VersionedTable(spark, table).refuse_fresh_checkpoint(checkpoint)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        merge_profile_epoch(spark, table, epoch_id, to_orders(batch), customers, buckets, series)

    stream = spark.readStream.schema(orders_schema).parquet(orders_dir)
    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()
