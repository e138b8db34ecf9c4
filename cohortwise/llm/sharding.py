"""Sharding by a Feistel permutation of global row numbers.

Rows get gapless global numbers in the order of their key; a keyed Feistel
network over the two digits of the number permutes them, walking on along its
cycle while the result lies outside the table. The permuted place gives shard
(place modulo shards) and slot (place divided by shards), so shards differ by
at most one row. Nothing about the shuffle is stored: ``shard_and_slot`` goes
from row number to shard and slot, ``row_at`` back, for any reader that knows
the number of rows and the seed.

All of it is DataFrame functions. Numbering deals the rows out by ranges of
the whole key, with equal rows spread by where they were read (they are alike,
so which of them is first does not show), counts each range, and adds the
counts of the ranges before it: one row per range, never one task for all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.llm.storage import written

SHARDS, SEED, ROUNDS = 16, 20_011, 6


def digits(rows: int) -> tuple[int, int]:
    """Radices (a, b) of the two digits of a row number: a * b >= rows, with fewer than a to spare."""
    a = max(math.isqrt(max(rows - 1, 0)) + 1, 1)
    return a, max(-(-rows // a), 1)


def _drawn(seed: int, j: Column, digit: Column) -> Column:
    """Round function: 32 bits of the MD5 of seed, round and digit."""
    name = F.concat_ws(":", F.lit(str(seed)), j.cast("string"), digit.cast("string"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long")


def feistel(number: Column, rows: int, seed: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """One pass of the network over 0 .. a * b - 1; each round adds a function
    of one digit to the other, so it is one to one whatever the function is."""
    a, b = digits(rows)
    low = number % F.lit(a)
    start = F.struct(low.cast("long").alias("l"), ((number - low) / F.lit(a)).cast("long").alias("r"))
    sign = F.lit(-1 if inverse else 1)

    def step(s: Column, j: Column) -> Column:
        odd = j % 2 == 1
        left = F.when(odd, F.pmod(s["l"] + sign * _drawn(seed, j, s["r"]), F.lit(a))).otherwise(s["l"])
        right = F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + sign * _drawn(seed, j, s["l"]), F.lit(b)))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    order = range(rounds, 0, -1) if inverse else range(1, rounds + 1)
    return F.aggregate(F.array(*[F.lit(j) for j in order]), start, step, lambda s: s["r"] * F.lit(a) + s["l"])


def permuted(number: Column, rows: int, seed: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """``number`` (below ``rows``) moved along its cycle: one pass, then on
    while outside the table. A walk meets each number outside at most once, and
    there are fewer than ``a`` of them, so ``a`` steps are always enough; less
    than one row in sqrt(rows) takes any."""
    if rows < 1:
        return number
    a, _ = digits(rows)

    def walk(x: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(a)), x, lambda y, _: F.when(
            y >= F.lit(rows), feistel(y, rows, seed, rounds, inverse)).otherwise(y))

    # the array of one element names the first pass, so that it is computed once
    return F.aggregate(F.array(F.lit(0)), feistel(number, rows, seed, rounds, inverse),
                       lambda x, _: F.when(x >= F.lit(rows), walk(x)).otherwise(x))


def shard_and_slot(place: Column, shards: int = SHARDS) -> tuple[Column, Column]:
    return (place % F.lit(shards)).cast("int"), F.floor(place / F.lit(shards)).cast("long")


def row_at(wanted: DataFrame, rows: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``wanted`` (``shard``, ``slot``) with ``row_number``: the row of the
    ordered table that the shuffle put there; null beyond the shard's end."""
    place = F.col("slot") * F.lit(shards) + F.col("shard")
    fits = place.between(0, rows - 1) & F.col("shard").between(0, shards - 1)
    return wanted.withColumn("row_number", F.when(fits, permuted(place, rows, seed, inverse=True)))


def numbered(df: DataFrame, by: list[Column]) -> tuple[DataFrame, int]:
    """(``df`` with ``row_number``, 0 up without gaps in the order of ``by``,
    and the number of rows). Rows alike in ``by`` are ordered by the hash of
    all their columns; rows alike in everything take any order."""
    keys = [c.alias(f"_k{i}") for i, c in enumerate(by)]
    rows = df.select(F.struct("*").alias("_row"), *keys, F.xxhash64(F.to_json(F.struct("*"))).alias("_h"),
                     F.monotonically_increasing_id().alias("_read"))
    order = [f"_k{i}" for i in range(len(by))] + ["_h", "_read"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number in the upper bits, position within it in the lower 33; written, so that they stay
    at = written(dealt.select("_row", F.monotonically_increasing_id().alias("_at")), "numbered")
    part, position = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = at.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sizes.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts")
    total = starts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]  # one number
    placed = at.join(F.broadcast(starts.select("_part", "_start")), part == F.col("_part"))
    return placed.select("_row", (F.col("_start") + position).alias("row_number")), int(total)


def sharded(df: DataFrame, by: list[Column], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``df`` plus a struct ``place``: ``row_number, shard,
    slot``. The rows of any table, ordered by ``by``, are shuffled into
    ``shards`` shards whose sizes differ by at most one.

    Null keys come first. Ties in the keys are broken by a hash of the whole
    row; rows that repeat in all columns get places of their own. Columns hold
    any values, texts of any length included. An empty table gives an empty
    result; a column of ``df`` named ``place`` is replaced.
    """
    rows, total = numbered(df, by)
    moved = rows.withColumn("_place", permuted(F.col("row_number"), total, seed))
    shard, slot = shard_and_slot(F.col("_place"), shards)
    return moved.select(*[F.col(f"_row.`{c}`") for c in df.columns if c != "place"],
                        F.struct("row_number", shard.alias("shard"), slot.alias("slot")).alias("place"))


def write_shards(docs: DataFrame, path: str, by: list[Column], shards: int = SHARDS, seed: int = SEED,
                 rows_per_file: int = 1_000_000) -> None:
    """The whole rows of ``docs`` as Parquet below ``path``, one folder
    ``shard=<n>`` each, files in slot order; a file holds a run of slots, so a
    hot shard is written by as many tasks as it has runs."""
    placed = sharded(docs, by, shards, seed)
    out = placed.withColumn("shard", F.col("place.shard")).withColumn("slot", F.col("place.slot")).drop("place")
    out.repartition(F.col("shard"), F.floor(F.col("slot") / F.lit(rows_per_file))).sortWithinPartitions("shard", "slot") \
        .write.mode("overwrite").partitionBy("shard").parquet(path)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every
    document: UTF-8 bytes of the text plus 1, its CRC-32, and its place in the
    shuffle of the documents ordered by id, size and CRC-32. A null text counts
    as no bytes. Only these numbers are dealt out, not the texts."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    facts = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                        F.crc32(text).alias("text_crc32"))
    placed = sharded(facts, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("place.shard").alias("shard"),
                         F.col("place.slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 of every text's bytes in DuckDB SQL, its table of 256 entries computed from the polynomial.
CRC_SQL = """bits AS (
        SELECT i, 0 AS t, i::UBIGINT AS c FROM range(256) numbers(i)
        UNION ALL SELECT i, t + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE t < 8),
    crcs AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE t = 8),
    named AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, xor(list_reduce(
            list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::UBIGINT)),
            lambda c, x: xor(c >> 8, crcs[1 + (xor(c, x) & 255)::INT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
        FROM documents, crcs)"""


def oracle_sql(shards: int = SHARDS, seed: int = SEED, rounds: int = ROUNDS) -> str:
    """The same shuffle in DuckDB SQL: a running row number, and a recursive
    walk that does one round of the network per step."""
    draw = f"('0x' || substr(md5('{seed}:' || (1 + t % {rounds}) || ':' || DIGIT), 1, 8))::BIGINT"
    return f"""
    WITH RECURSIVE {CRC_SQL},
    facts AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_no FROM named),
    k AS (SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)))::BIGINT + 1 AS a FROM facts),
    d AS (SELECT n, a, greatest(ceil(n / a)::BIGINT, 1) AS b FROM k),
    walk AS (
        SELECT row_no, 0 AS t, row_no % a AS l, row_no // a AS r FROM facts, d
        UNION ALL
        SELECT row_no, t + 1, CASE WHEN t % {rounds} % 2 = 0 THEN (l + {draw.replace('DIGIT', 'r')}) % a ELSE l END,
               CASE WHEN t % {rounds} % 2 = 0 THEN r ELSE (r + {draw.replace('DIGIT', 'l')}) % b END
        FROM walk, d WHERE t = 0 OR t % {rounds} <> 0 OR r * a + l >= n),
    places AS (SELECT row_no, arg_max(r * a + l, t) AS place FROM walk, d GROUP BY row_no)
    SELECT doc_id, size, text_crc32, 'rows' AS law, (place % {shards})::INT AS shard, place // {shards} AS slot,
           NULL::INT AS grown_shard
    FROM facts JOIN places USING (row_no)"""
