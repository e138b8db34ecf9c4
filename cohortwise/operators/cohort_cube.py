"""Cohorts over any dimensions and any periods, from stored mergeable parts.

A distinct count of one month does not add up to that of a quarter, and one
pass per list of keys reads the orders once per list. So the smallest parts are
kept as bitmaps: every customer gets a number within its cell (cohort month and
dimensions), and a part holds, for a cell, an activity month and a chunk of
32,768 numbers, the members that were active.

* months merge into periods by OR of the bitmaps of a cell and chunk: a member
  active in several months of the period is one bit
* cells add up over the dimensions: each customer belongs to exactly one cell,
  so counts of disjoint cells are sums, and all grouping sets come from one
  aggregation of counts, no customer being read again
* a batch of new orders appends parts; a month delivered again, or in pieces,
  is the same bits once more

Numbers are dense within a cell, so a part is nearly full wherever a cell has
many members. ``salts`` deals the members of a cell over several ranges of
numbers, for cells too large for one window task.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.functions.dates import month_diff
from cohortwise.functions.numeric import share_pct


def number_members(months: DataFrame, attributes: DataFrame, dims: list[str], known: DataFrame | None = None,
                   salts: int = 1) -> DataFrame:
    """``customer_id, cohort_month, <dims>, salt, number`` (1 up within cell and
    salt) of the customers of ``months`` (``customer_id, cohort_month``).

    With ``known``, a table of members, those keep their cell and number and
    only new ones are returned, numbered after them. A customer keeps the cell
    it was first given; ``attributes`` that list one twice give its least row."""
    one = attributes.select("customer_id", F.struct(*dims).alias("_d")).groupBy("customer_id").agg(F.min("_d").alias("_d"))
    new = months.select("customer_id", "cohort_month").distinct()
    if known is not None:
        new = new.join(known.select("customer_id"), "customer_id", "left_anti")
    cells = new.join(one, "customer_id", "left").select(
        "customer_id", "cohort_month", *[F.col(f"_d.{d}").alias(d) for d in dims],
        F.pmod(F.xxhash64("customer_id"), F.lit(int(salts))).cast("int").alias("salt"))
    cell = ["cohort_month", *dims, "salt"]
    numbered = cells.withColumn("number", F.row_number().over(Window.partitionBy(*cell).orderBy("customer_id")).cast("long"))
    if known is None:
        return numbered
    used = known.groupBy(*[F.col(c).alias(f"_k_{c}") for c in cell]).agg(F.max("number").alias("_used"))
    both = numbered.join(used, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cell], "left")
    return both.select("customer_id", *cell, (F.col("number") + F.coalesce("_used", F.lit(0))).alias("number"))


def activity_parts(months: DataFrame, members: DataFrame, dims: list[str]) -> DataFrame:
    """``cohort_month, <dims>, salt, activity_month, chunk, active`` (bitmap):
    the stored parts of ``months`` (``customer_id, months``). Activity before
    a member's cohort month is left out."""
    seen = months.select("customer_id", F.explode("months").alias("activity_month")).join(members, "customer_id")
    return seen.where(F.col("activity_month") >= F.col("cohort_month")).groupBy(
        "cohort_month", *dims, "salt", "activity_month", F.bitmap_bucket_number("number").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("active"))


def cohort_cube(parts: DataFrame, dims: list[str], months_per_period: int = 1, sets: list[list[str]] | None = None) -> DataFrame:
    """``grouping, cohort_month, <dims>, period, cohort_size, active_customers,
    retention_rate`` of every grouping set (all subsets of ``dims`` by
    default): period 0 is the first ``months_per_period`` months from the
    cohort month on, ``grouping`` a bit per dimension that is summed over."""
    period = F.floor(month_diff("cohort_month", "activity_month") / F.lit(int(months_per_period))).cast("long")
    cells = parts.groupBy("cohort_month", *dims, "salt", "chunk", period.alias("period")).agg(
        F.bitmap_count(F.bitmap_or_agg("active")).alias("n"))
    keys = ["cohort_month", "period"]
    chosen = sets if sets is not None else [list(c) for n in range(len(dims) + 1) for c in combinations(dims, n)]
    cube = cells.groupingSets([[F.col(c) for c in (*keys, *s)] for s in chosen], *[F.col(c) for c in (*keys, *dims)]).agg(
        F.sum("n").cast("long").alias("active_customers"), F.grouping_id().cast("long").alias("grouping"))
    # every member is active in its cohort month, which lies in period 0
    group = Window.partitionBy("grouping", "cohort_month", *dims)
    size = F.max(F.when(F.col("period") == 0, F.col("active_customers"))).over(group)
    out = cube.withColumn("cohort_size", size.cast("long"))
    return out.select("grouping", "cohort_month", *dims, "period", "cohort_size", "active_customers",
                      share_pct("active_customers", "cohort_size", 2).alias("retention_rate"))
