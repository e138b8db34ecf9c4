"""Fill-in-middle: chunks against plain line splitting, the round trip, edges."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortwise.llm import fill_middle as fim

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def brute(i, text, percent=100, spm=50):
    """(n, form, prefix_chars, middle_chars, output) by splitting into lines."""
    text = text or ""
    lines, n = LINE.findall(text), len(LINE.findall(text))
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(lines[:x]), "".join(lines[x:y]), "".join(lines[y:])
    if h4 % 100 < spm:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def rows_of(df, **kw):
    done = fim.transform(df, **kw)
    return done.select("*", fim.restored(F.col("form"), F.col("fim_text")).alias("back")).collect()


def test_rolling_hash_depends_on_the_span_alone():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 5000).astype(np.uint8)
    h = fim.rolling(raw)
    for at in range(fim.SPAN, 5000, 97):
        assert fim.rolling(raw[at - fim.SPAN:at])[-1] == h[at - 1]
    want = sum(int(fim._GEAR[raw[99 - k]]) << k for k in range(fim.SPAN)) % 2**32
    assert int(h[99]) == want


def test_shared_passages_share_chunks():
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh \n") for _ in range(40_000)).encode()
    texts = [bytes(rng.randrange(97, 123) for _ in range(k)) + passage for k in (10, 501, 3333)]
    summaries = fim.Summaries()
    for t in texts:
        fim.Text(np.frombuffer(t, np.uint8), t, summaries)
    assert summaries.hits > 0.9 * 2 * summaries.misses * 20_000 / 40_000 and summaries.hits > 30


def test_small_cache_gives_the_same_sums():
    text = ("line é\n" * 3000 + "end").encode()
    raw = np.frombuffer(text, np.uint8)
    large, small = fim.Text(raw, text, fim.Summaries()), fim.Text(raw, text, fim.Summaries(limit=2000))
    none = fim.Text(raw, text, fim.Summaries(limit=0))
    for units in (0, 1, 2, 1500, 2999, 3000, 3001, 9999):
        assert large.cut(units) == small.cut(units) == none.cut(units)
    assert large.units == 3001 and large.cut(3000) == (24_000, 21_000) and large.cut(3001) == (24_003, 21_003)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\né漢😀<PSM>\r", max_size=120), st.integers(0, 130))
def test_cut_equals_lines(text, units):
    data = text.encode()
    lines = LINE.findall(text)
    got = fim.Text(np.frombuffer(data, np.uint8), data, fim.Summaries())
    head = "".join(lines[:units])
    assert got.units == len(lines) and got.cut(units) == (len(head.encode()), len(head))


def test_transform_brute(spark):
    rng = random.Random(9)
    words = ["alpha", "b", "ç", "漢字", "😀", "<", "P>", "<P", "<S", "<M>", ">", "\n", "\n\n", "x" * 300, "\r\n"]
    passage = " ".join(rng.choice(words[:5]) + ("\n" if rng.random() < 0.2 else "") for _ in range(5000))
    rows = [(i, "".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(i, f"head {i}\n" + passage + f"\ntail {i}" * (i % 3)) for i in range(300, 340)]
    got = {r.doc_id: r for r in rows_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))}
    forms = set()
    for i, text in rows:
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == brute(i, text), i
        assert r.back == text
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_shares(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\nd").alias("text"))
    some = rows_of(df, percent=30)
    assert [r.form == "plain" for r in some] == [brute(r.doc_id, "a\nb", percent=30)[1] == "plain" for r in some]
    assert {r.form for r in rows_of(df, spm_percent=100)} == {"spm"} and {r.form for r in rows_of(df, spm_percent=0)} == {"psm"}


def test_long_texts_are_cut_whole(spark):
    rng = random.Random(3)
    long = "\n".join("word " * rng.randrange(40) + "é" for _ in range(60_000))  # several pieces
    flat = "y" * 3_000_000  # one line, no chunk border
    assert len(long.encode()) > 4 * fim.PIECE
    for r in rows_of(spark.createDataFrame([(5, long), (6, flat), (7, long)], "doc_id long, text string")):
        text = flat if r.doc_id == 6 else long
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == brute(r.doc_id, text) and r.back == text


def test_edges(spark, edges, nothing):
    got = rows_of(edges)
    assert len(got) == edges.count()
    for row in edges.select("doc_id", "text").collect():
        mine = [r for r in got if r.doc_id == row.doc_id and r.back == (row.text or "")]
        assert mine and all((r.n, r.form, r.prefix_chars, r.middle_chars, r.fim_text) == brute(row.doc_id, row.text) for r in mine)
    out = fim.transform(nothing)
    assert out.count() == 0 and out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "fim_text"]
