"""Trailing windows from running totals per customer and day.

A count over the last w days is the running total on the day minus that of w
days before. The running totals are stored once (``running_totals``: a row per
customer and day with an event, valid until the next such day); any windows on
any days are then look-ups in them: a row answers for the days it is valid on,
so one narrow pass lists the signed totals that the windows ask for, and one
sum per customer and day puts them together. The events are not read again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_totals(events: DataFrame, keys: list[str] | None = None, date_col: str = "event_date") -> DataFrame:
    """``customer_id, <keys>, day, until, total``: events of the customer up to
    and including ``day``, valid to the day before ``until`` (NULL: for good).
    Events are reduced per customer day first; the window holds at most one row
    per calendar day. Undated events are left out."""
    keys = ["customer_id", *(keys or [])]
    per_day = events.where(F.col(date_col).isNotNull()).groupBy(*keys, F.col(date_col).alias("day")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("day")
    return per_day.select(*keys, "day", F.lead("day").over(w).alias("until"),
                          F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long").alias("total"))


def trailing_counts(totals: DataFrame, days: list, windows: list[int], keys: list[str] | None = None,
                    name: str = "events") -> DataFrame:
    """``customer_id, <keys>, snapshot_date, <name>_<w>``...: events in the
    ``w`` days up to and including each day, for every window. Customers
    without an event up to a day have no row for it."""
    keys = ["customer_id", *(keys or [])]
    asked = []
    for day in days:
        d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
        asked.append(F.struct(F.lit(d).alias("snapshot_date"), F.lit(d).alias("at"), F.lit(0).alias("w")))
        asked += [F.struct(F.lit(d).alias("snapshot_date"), F.lit(d - _dt.timedelta(days=w)).alias("at"), F.lit(w).alias("w")) for w in windows]
    valid = F.filter(F.array(*asked), lambda a: (a["at"] >= F.col("day")) & (F.col("until").isNull() | (a["at"] < F.col("until"))))
    answers = totals.select(*keys, "total", F.inline(valid))
    now = F.coalesce(F.sum(F.when(F.col("w") == 0, F.col("total"))), F.lit(0))
    out = answers.groupBy(*keys, "snapshot_date").agg(*[
        (now - F.coalesce(F.sum(F.when(F.col("w") == w, F.col("total"))), F.lit(0))).alias(f"{name}_{w}") for w in windows])
    return out
