"""Configuration tables as literal relations.

Threshold sets, segment weights, band rules and the like are given as Python
rows. Built from literals, their size is known to the planner, so it picks the
join without a hint, a size check of our own or a job while a query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(rows, schema: str) -> Column:
    """The rows as one array of structs."""
    fields = T.StructType.fromDDL(schema).fields
    return F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)]) for r in rows])


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """The rows as a DataFrame; at least one row."""
    return spark.range(1).select(F.inline(literal_rows(rows, schema)))
