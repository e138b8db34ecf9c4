"""Exact dedup by skew-safe combining.

Rows are grouped by the digest and the *whole* normalised text at every
stage, so equal digests are never trusted alone:

1. locally: the map side of the first aggregation merges equal texts within
   each task (a hot group leaves a task as at most ``salts`` rows);
2. salted: rows of one digest are dealt over ``salts`` groups by a hash of
   their id and merged there;
3. globally: the salt winners of a text are merged; the salts that occurred
   are kept as a bit mask of fixed width.

The verdict goes back to the rows over (digest, salt), so a group that holds
a third of all rows is joined in ``salts`` parts. A digest that two different
texts share makes the job fail loudly instead of merging them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 48


def normalised(text: Column | str) -> Column:
    """Every run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                            r"[\x20\x09-\x0D]+", " ")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the smallest id stays. Null texts are empty
    texts and equal to them; rows with a null id lose against any id, and if
    all ids of a group are null one row of it stays with a null ``keep_id``.
    Rows that repeat both id and text count one by one in ``group_size`` and
    one of them stays. An empty table gives an empty result; other columns
    are not read, whatever their names. Texts of any length are compared whole.
    """
    if not 1 <= salts <= 63:
        raise ValueError("salts must be between 1 and 63")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), normalised(text_col).alias("_text"))
    rows = rows.select("_id", "_text", F.sha2("_text", 256).alias("_digest"),
                       F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"))
    salted = rows.groupBy("_digest", "_salt", "_text").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    merged = salted.groupBy("_digest", "_text").agg(
        F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_salt"))).alias("_salts"))
    # different texts must not meet in one digest from here on
    winners = merged.groupBy("_digest").agg(
        F.min("_keep").alias("keep_id"), F.sum("_n").alias("group_size"), F.bit_or("_salts").alias("_salts"),
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share one SHA-256 digest")).cast("int"))
        .alias("_clash"))
    winners = winners.where(F.col("_clash").isNull()).select(
        "_digest", "keep_id", "group_size",
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(salts - 1)),
                           lambda s: F.getbit("_salts", s) == 1)).alias("_salt"))
    back = rows.select("_id", "_digest", "_salt").join(winners, ["_digest", "_salt"])
    # rows that repeat an id share its salt: rank them there
    nth = F.row_number().over(Window.partitionBy("_digest", "_salt", "_id").orderBy(F.lit(1)))
    return back.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (nth == 1)).alias("kept"),
        F.col("_digest").alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat id and text are one row of the result; which one is
    taken of those that differ in other columns is not defined.
    """
    def key(row_id, sha):  # one column, so that join and final choice share a partitioning
        return F.concat_ws("|", sha, row_id.cast("string"))

    kept = groups(docs, id_col, text_col).where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    rows = docs.select(F.struct("*").alias("row"),  # the row's own names stay inside
                       key(F.col(id_col).cast("long"), F.sha2(normalised(text_col), 256)).alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
