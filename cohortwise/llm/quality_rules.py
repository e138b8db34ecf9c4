"""Quality rules: base counts, and the log-likelihood ratio of hashed word
n-grams between a trusted target and the raw corpus.

Both multinomials are counted over all texts of their side: every word and
every pair of neighbouring words falls into one of ``buckets`` hash buckets.
A text's score is the mean log ratio of its n-grams, so it does not depend on
length; a fixed threshold decides. All steps are DataFrame functions. Only
the ``buckets`` bucket weights, a size fixed by parameter, meet on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
SMOOTHING = 40.0
#: Mean log ratio under which a text is rejected. Clean texts whose labels were held out scored above -0.10 on
#: corpora of 200 to 51,282 documents; over half of the labelled junk scores below -0.12.
THRESHOLD = -0.12
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def hashed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the arrays ``_h`` and ``_h2``: hashes of all words and of
    all pairs of neighbours. Each array is a column of its own, so that it is
    computed once however often it is used."""
    trimmed = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    docs = docs.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    return docs.withColumn("_h2", pairwise(F.col("_h"), F.col("_h"), 1))


def pairwise(left: Column, right: Column, gap: int) -> Column:
    """Hashes of (left[i], right[i + gap]) for all i that both have."""
    n = F.greatest(F.size(right) - gap, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(gap + 1), n), lambda a, b: F.xxhash64(a, b))


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """``bucket, weight``: log ratio of each bucket that occurs, over all texts.

    ``trusted`` names the target's rows by their ids (nulls and repeats in it
    are ignored). The raw counts take ``smoothing`` per bucket, the target's
    as much in proportion to its share, so an unseen bucket leans to zero.
    Without any trusted n-gram all weights are zero.
    """
    ids = trusted.select(F.col(id_col).alias("_tid")).where("_tid IS NOT NULL").distinct()
    # dealt out by id at every size: how many rows are trusted has no bound
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        ids.hint("merge"), F.col("_id") == F.col("_tid"), "left").select("_text", F.col("_tid").isNotNull().cast("int").alias("_target"))
    grams = hashed(marked, "_text").select("_target", F.explode(F.concat("_h", "_h2")).alias("_gram")).select(
        F.pmod("_gram", F.lit(buckets)).cast("int").alias("bucket"), "_target")
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_target").alias("target"))
    total = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    share = F.col("targets") / F.col("raws")
    return counts.join(F.broadcast(total)).select(
        "bucket", F.when(F.col("targets") > 0, F.log((F.col("target") + F.lit(smoothing) * share) /
                                                     ((F.col("raw") + F.lit(smoothing)) * share)))
        .otherwise(F.lit(0.0)).alias("weight"))


def rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus a struct ``quality`` with ``n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept``.

    A null or blank text has no words, score 0 and fails the base rules. Rows
    that repeat are judged alike, each for itself; a row's id is used only to
    look up whether it is trusted (null: not). Long texts are judged whole.
    An empty table gives an empty result. A column of ``docs`` named
    ``quality`` is replaced in the result.

    Do not filter the result on its verdict: the filter would be pushed below
    the arrays and compute them again in every place. ``kept`` does it safely.
    """
    judged = _judged(docs, trusted, id_col, text_col, buckets, smoothing, threshold)
    return judged.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c != "quality"], "quality")


def kept(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         buckets: int = BUCKETS, smoothing: float = SMOOTHING, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. The
    filter also asks for a row number, which is always there: Catalyst moves no
    filter below a projection that numbers rows, so the verdict is computed
    once. Edge cases as in ``rules``."""
    judged = _judged(docs, trusted, id_col, text_col, buckets, smoothing, threshold)
    stays = judged.select("_row", F.col("quality.kept").alias("_kept"), F.monotonically_increasing_id().alias("_nth"))
    return stays.where(F.col("_kept") & (F.col("_nth") >= 0)).select("_row.*")


def _judged(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int, smoothing: float,
            threshold: float) -> DataFrame:
    """The row as the struct ``_row``, and ``quality``."""
    weights = bucket_weights(docs, trusted, id_col, text_col, buckets, smoothing).collect()  # at most ``buckets`` rows
    table = [0.0] * buckets
    for row in weights:
        table[row["bucket"]] = row["weight"] if math.isfinite(row["weight"]) else 0.0
    vector = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")  # folded into one literal

    text, n = F.coalesce(F.col("_text"), F.lit("")), F.size("_h")

    def total(hashes):
        return F.aggregate(hashes, F.lit(0.0), lambda acc, x: acc + F.get(vector, F.pmod(x, F.lit(buckets)).cast("int")))

    # the row's own names stay inside a struct, apart from the working columns
    rows = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    step = hashed(rows, "_text").withColumn(
        "_lines", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    step = step.withColumns({
        "_base": F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.when(n > 0, (total(F.col("_h")) + total(F.col("_h2"))) / (F.lit(2) * n - 1)).otherwise(F.lit(0.0)).alias("llr")),
        "_h4": pairwise(F.col("_h2"), F.col("_h2"), 2)})
    step = step.withColumn("_windows", pairwise(F.col("_h4"), F.col("_h"), WINDOW - 1)).drop("_h", "_h2", "_h4", "_lines")
    # texts with a window found twice: (hash, position) in order, else nothing
    step = step.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(
        F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_windows")
    step = step.withColumn("_starts", repeated_starts(F.col("_sorted"))).drop("_sorted")
    step = step.withColumn("quality", F.struct("_base.*", F.coalesce(covered(F.col("_starts")), F.lit(0)).cast("long")
                                               .alias("n_repeat_words"))).drop("_base", "_starts")
    n = F.col("quality.n_words")
    failed = (n < 10) | (F.lit(100) * F.col("quality.n_repeat_words") > F.lit(20) * n)
    return step.select("_row", F.struct(
        *[F.col(f"quality.{c}").alias(c) for c in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")],
        failed.alias("base_failed"), (~failed & (F.col("quality.llr") >= F.lit(threshold))).alias("kept")).alias("quality"))


def repeated_starts(ordered: Column) -> Column:
    """Positions, in order, of windows whose hash equals a neighbour's among
    the ordered (hash, position) pairs."""
    n = F.size(ordered)
    nobody = F.array(F.lit(None).cast("bigint"))
    hashes = F.transform(ordered, lambda p: p["x"])
    before = F.concat(nobody, F.slice(hashes, F.lit(1), n - 1))
    after = F.concat(F.slice(hashes, F.lit(2), n - 1), nobody)
    same = F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a")))
    marked = F.zip_with(ordered, same, lambda p, near: F.when(
        p["x"].eqNullSafe(near["b"]) | p["x"].eqNullSafe(near["a"]), p["i"]))
    return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))


def covered(starts: Column) -> Column:
    """Words that windows at these positions cover: the gaps, each at most ``WINDOW``."""
    return F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
