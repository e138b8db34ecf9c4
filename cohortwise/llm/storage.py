"""Tables written to the cluster's shared folder, to cut lineage and to feed
several readers. ``spark.checkpoint.dir`` names the folder; only a local
session without it gets a scratch one (see ``cohortwise.session``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortwise.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for one table of one run."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: later
    steps neither recompute it nor lose it with an executor."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
