"""Registered queries of the package: each applies one operator, with its
production parameters, to its whole table and derives the digest columns its
contract asks for. ``ORACLES`` holds DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm import (bpe, exact_dedup, fill_middle, hard_negatives, html_text, licences, mixing, near_dedup,
                            quality_classifier, quality_rules, sharding, substring_dedup, warc)
from cohortwise.llm.shipping import ship
from cohortwise.llm.storage import scratch, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


@query("op5_exact_dedup", r"""
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY words ORDER BY doc_id) = 1 AS kept, sha256(words) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS words FROM documents)
    WINDOW same AS (PARTITION BY words)""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    judged = quality_rules.rules(table(spark, sf_dir, "documents"), trusted)
    return judged.select("doc_id", *[F.col(f"quality.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")])


@query("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks).drop("token_ends"), ranks)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_mixing", mixing.oracle_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(table(spark, sf_dir, "documents")).select(
        "doc_id", "mix.topic", "mix.n_tokens", F.round("mix.probability", 6).alias("probability"), "mix.kept")


@query("op2_warc", r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS last FROM p)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM h""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.captures(warc.read_records(spark, path))
    revisit = F.col("response.record_type") == "revisit"
    flat = written(found.select(
        "capture_id", F.expr("nullif(regexp_extract(decode(metadata.payload, 'UTF-8'), 'page-id: (-?[0-9]+)', 1), '')")
        .cast("long").alias("page_id"),
        F.when(~revisit, F.octet_length("response.payload").cast("long")).alias("own_bytes"),
        F.when(revisit, F.col("response.payload_digest")).otherwise(warc.base32_sha1(F.col("response.payload"))).alias("payload_digest"),
        F.col("response.record_type").alias("record_type"), F.col("response.refers_to").alias("refers_id")), "captures")
    target = flat.select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("full_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    own = flat.where("refers_id IS NULL").withColumns({"payload_bytes": F.col("own_bytes"), "refers_to": F.lit(None).cast("long")})
    # only revisits look for their response
    again = flat.where("refers_id IS NOT NULL").join(target, "refers_id", "left").withColumn(
        "payload_bytes", F.coalesce("own_bytes", "full_bytes"))
    return own.select(*columns).unionByName(again.select(*columns))


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_substring_dedup", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
    repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE doc_id > first),
    covered AS (SELECT DISTINCT doc_id, i + k AS j FROM repeated, (SELECT unnest(range(0, 13)) AS k)),
    each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
    left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
                  FROM each ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id)
    SELECT doc_id, len(ws)::BIGINT AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN left_over USING (doc_id)""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op1_licence_scan", licences.oracle_sql())
def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))


@query("op11_hard_negatives", hard_negatives.oracle_sql())
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


@query("op12_fill_middle", fill_middle.oracle_sql())
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.transform(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim_text", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("form"), F.col("fim_text")), 256).alias("restored_sha256"))


@query("op13_sharding", sharding.oracle_sql())
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.documents(table(spark, sf_dir, "documents"))
