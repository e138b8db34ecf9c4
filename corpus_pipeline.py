"""Corpus pipeline: five stages over ``documents``, each one operator of
``cohortwise.llm``. A stage takes (spark, docs, sf_dir); its result is written
as Parquet and read back as the next stage's ``docs``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules
from cohortwise.llm.shipping import ship
from cohortwise.llm.storage import written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; trusted are the rows labelled 1."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return quality_rules.kept(docs, trusted)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.deduplicate(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled to the target weights."""
    return mixing.sampled(docs).where("mix.kept").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    decoded = bpe.decode(bpe.encode(docs, RANKS).drop("token_ends"), RANKS)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near),
          ("mixing", mix), ("byte-level bpe", tokens)]

#: Near dedup and pair merging are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
