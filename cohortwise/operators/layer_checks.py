"""All checks of a layer in one pass over it.

The single checks (``quality``) scan the layer once each. Here the counters of
several are fused into one aggregation, or collected as observed metrics while
the layer is written, so that the write is the only pass.

Rows come out as ``check_id, item, metric, value``: Q4 customers per status, Q5
recency span, uniqueness and future orders, Q6 recency range per status, Q7
customers with several statuses on a day; Q8, Q9 and Q11 for the risk layer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortwise.config import LEVELS, STATUSES

SCHEMA = "check_id string, item string, metric string, value double"


def _rows(entries: list[tuple[str, str, str, Column]]) -> Column:
    """The long rows, without those that have no value."""
    return F.filter(F.array(*[F.struct(F.lit(c).alias("check_id"), F.lit(i).alias("item"), F.lit(m).alias("metric"),
                                       v.cast("double").alias("value")) for c, i, m, v in entries]), lambda r: r["value"].isNotNull())


def _per_status(of: Callable[[str, str], Column]) -> list[tuple[str, str, str, Column]]:
    out = []
    for s in STATUSES:
        out.append(("Q4", s, "customer_count", F.nullif(of(s, "n"), F.lit(0))))
        out += [("Q6", s, "min_days", of(s, "lo")), ("Q6", s, "max_days", of(s, "hi"))]
    return out


def snapshot_checks(snapshot: DataFrame) -> DataFrame:
    """Q4 to Q7 of a snapshot layer (one day or several) from one scan: counters
    per customer and day, then per customer, then over all; every step is
    combined before it is shuffled."""
    days, status = F.col("days_since_last_order"), F.col("retention_status")
    first = []
    for k, s in enumerate(STATUSES):
        own = F.when(status == s, days)
        first += [F.count_if(status == s).alias(f"n{k}"), F.min(own).alias(f"lo{k}"), F.max(own).alias(f"hi{k}")]
    per_day = snapshot.groupBy("customer_id", "snapshot_date").agg(
        *first, F.count(F.lit(1)).alias("rows"), F.min(days).alias("lo"), F.max(days).alias("hi"), F.count_if(days < 0).alias("future"),
        F.size(F.collect_set("retention_status")).alias("statuses"))  # at most the statuses there are

    def merged(extra: list[Column]) -> list[Column]:
        out = [F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("future").alias("future"), *extra]
        for k in range(len(STATUSES)):
            out += [F.sum(f"n{k}").alias(f"n{k}"), F.min(f"lo{k}").alias(f"lo{k}"), F.max(f"hi{k}").alias(f"hi{k}")]
        return out

    per_customer = per_day.groupBy("customer_id").agg(*merged([F.count_if(F.col("statuses") > 1).alias("several")]))
    total = per_customer.agg(*merged([F.sum("several").alias("several"), F.count("customer_id").alias("unique")]))
    entries = _per_status(lambda s, what: F.col(f"{what}{STATUSES.index(s)}"))
    entries += [("Q5", "all", "min_days", F.col("lo")), ("Q5", "all", "max_days", F.col("hi")), ("Q5", "all", "unique_customers", F.col("unique")),
                ("Q5", "all", "total_rows", F.col("rows")), ("Q5", "all", "future_orders", F.col("future")),
                ("Q7", "all", "multi_status_customers", F.col("several"))]
    return total.select(F.inline(_rows(entries)))


def risk_checks(risk: DataFrame) -> DataFrame:
    """Q8, Q9 and Q11 of a risk layer from one aggregation per (status, level)."""
    cells = risk.groupBy("retention_status", "churn_risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("churn_risk_score") < 0) | (F.col("churn_risk_score") > 100)).alias("out"))
    item = F.concat_ws("|", "retention_status", "churn_risk_level")
    fine = cells.select(F.lit("Q9").alias("check_id"), item.alias("item"), F.lit("customer_count").alias("metric"), F.col("n").cast("double").alias("value"))
    total = cells.agg(*[F.sum(F.when(F.col("churn_risk_level") == x, F.col("n"))).alias(x) for x in LEVELS], F.sum("out").alias("out"))
    entries = [("Q8", x, "customer_count", F.col(x)) for x in LEVELS] + [("Q11", "all", "out_of_range", F.col("out"))]
    return fine.unionByName(total.select(F.inline(_rows(entries))))


def write_observed(snapshot: DataFrame, write: Callable[[DataFrame], None]) -> DataFrame:
    """Writes a snapshot layer and returns Q4, Q5 (without uniqueness, which
    needs a shuffle) and Q6 as they were counted during the write."""
    spark: SparkSession = snapshot.sparkSession
    days, status = F.col("days_since_last_order"), F.col("retention_status")
    seen = Observation()
    counters = [F.count(F.lit(1)).alias("rows"), F.min(days).alias("lo"), F.max(days).alias("hi"), F.count_if(days < 0).alias("future")]
    for k, s in enumerate(STATUSES):
        own = F.when(status == s, days)
        counters += [F.count_if(status == s).alias(f"n{k}"), F.min(own).alias(f"lo{k}"), F.max(own).alias(f"hi{k}")]
    write(snapshot.observe(seen, *counters))
    got = seen.get  # one row of counters
    rows = [("Q5", "all", m, got[c]) for m, c in (("total_rows", "rows"), ("min_days", "lo"), ("max_days", "hi"), ("future_orders", "future"))]
    for k, s in enumerate(STATUSES):
        rows += [("Q4", s, "customer_count", got[f"n{k}"] or None), ("Q6", s, "min_days", got[f"lo{k}"]), ("Q6", s, "max_days", got[f"hi{k}"])]
    return spark.createDataFrame([(c, i, m, float(v)) for c, i, m, v in rows if v is not None], SCHEMA)
