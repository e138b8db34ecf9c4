"""Feistel sharding: the permutation, gapless numbers, shards by brute force, edges."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortwise.llm import sharding


def brute_place(x, n, seed=sharding.SEED, rounds=sharding.ROUNDS):
    """The walk in plain integers."""
    a, b = sharding.digits(n)

    def draw(j, digit):
        return int(hashlib.md5(f"{seed}:{j}:{digit}".encode()).hexdigest()[:8], 16)
    while True:
        left, right = x % a, x // a
        for j in range(1, rounds + 1):
            if j % 2:
                left = (left + draw(j, right)) % a
            else:
                right = (right + draw(j, left)) % b
        x = right * a + left
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 26, 1000, 1025])
def test_permutation(spark, n):
    got = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("p")).select(
        "id", "p", sharding.permuted(F.col("p"), n, inverse=True).alias("back")).collect()
    assert sorted(r.p for r in got) == list(range(n))
    assert all(r.back == r.id and r.p == brute_place(r.id, n) for r in got)


def test_digits_leave_little_outside():
    for n in [*range(1, 300), 10**6, 10**12 + 7]:
        a, b = sharding.digits(n)
        assert n <= a * b < n + a


def test_seeds_differ_and_repeat(spark):
    def order(seed):
        return [r.p for r in spark.range(500).select(sharding.permuted(F.col("id"), 500, seed).alias("p")).collect()]
    assert order(1) == order(1) != order(2)
    # neighbours do not stay neighbours
    first = order(1)
    assert sum(abs(x - y) == 1 for x, y in zip(first, first[1:])) < 20


def check_shards(rows, shards):
    assert {r.shard for r in rows} <= set(range(shards))
    by = Counter(r.shard for r in rows)
    assert max(by.values()) - min(by.get(s, 0) for s in range(shards)) <= 1
    for s in by:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by[s]))


def test_documents_brute(spark):
    rows = [(i * 7 % 400 - 30, None if i % 11 == 0 else f"text {i}" * (i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.documents(df).collect()
    check_shards(got, 16)
    ordered = sorted(rows, key=lambda r: r[0])
    want = {i: brute_place(k, 400) for k, (i, _) in enumerate(ordered)}
    text = {i: (t or "").encode() for i, t in rows}
    for r in got:
        assert (r.shard, r.slot) == (want[r.doc_id] % 16, want[r.doc_id] // 16)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]), "rows", None)
    # the dealing of the input does not matter
    again = sharding.documents(df.repartition(2)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_hot_key_is_numbered_without_gaps(spark):
    """A third of all rows share their id, a part of them everything."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"),
                                  F.when(F.col("id") % 6 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows, n = sharding.numbered(df, [F.col("doc_id")])
    assert n == 3000 and sorted(r.row_number for r in rows.collect()) == list(range(3000))
    ids = [r.d for r in rows.orderBy("row_number").select(F.col("_row.doc_id").alias("d")).collect()]
    assert ids == sorted(ids)
    check_shards(sharding.documents(df).collect(), 16)


def test_row_at_inverts(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    placed = sharding.sharded(df, [F.col("doc_id")], shards=7)
    asked = placed.select("place.shard", "place.slot", F.col("place.row_number").alias("want"))
    got = sharding.row_at(asked, 100, shards=7).collect()
    assert all(r.row_number == r.want for r in got)
    beyond = spark.createDataFrame([(0, 99), (7, 0), (-1, 3), (None, 1)], "shard int, slot long")
    assert [r.row_number for r in sharding.row_at(beyond, 100, shards=7).collect()] == [None] * 4


def test_write_shards(spark, tmp_dir):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    sharding.write_shards(df, f"{tmp_dir}/shards", [F.col("doc_id")], shards=4, rows_per_file=20)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    rows = back.collect()
    check_shards(rows, 4)
    assert sorted((r.doc_id, r.text) for r in rows) == sorted((i, f"t{i}") for i in range(200))
    assert back.select(F.input_file_name()).distinct().count() >= 4


def test_edges(spark, edges, nothing):
    got = sharding.documents(edges).collect()
    assert len(got) == edges.count()
    check_shards(got, 16)
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 3} == {(1, 0)}
    assert sharding.documents(nothing).count() == 0 and sharding.documents(nothing).columns == sharding.documents(edges).columns
    whole = sharding.sharded(edges.withColumn("place", F.lit("x")), [F.col("doc_id")], shards=3)
    assert set(whole.columns) == {*edges.columns, "place"} and whole.schema["place"].dataType.fieldNames() == ["row_number", "shard", "slot"]
    assert sorted(map(str, whole.drop("place").collect())) == sorted(map(str, edges.collect()))
    assert sharding.sharded(nothing, [F.col("doc_id")]).count() == 0
