"""Quality rules, BPE, licences, mixing and the classifier."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortwise.llm import bpe, licences, mixing, quality_classifier, quality_rules
from cohortwise.llm.kernels import Words
from tests.llm.cases import EDGES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_kernel_words_and_windows():
    texts = ["a  bb\tccc", None, "", " x", "A b", "ü é ", "a bb"]
    w = Words(pa.array(texts))
    assert w.count.tolist() == [3, 0, 0, 1, 2, 2, 2]
    spelled = [bytes(w.raw[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert spelled == [x for t in texts for x in WORD.findall(t or "")]
    assert len(set(w.hash.tolist())) == len(set(spelled))
    pairs, valid = w.windows(2)
    assert valid.tolist() == [True, True, False, False, True, False, True, False, True, False]
    assert pairs[0] == pairs[8]  # "a bb" in two texts


def base_brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def rule_rows(df):
    return df.select("doc_id", "text", "quality.*").collect()


def test_rules_against_brute_force(spark, corpus):
    docs, labels = corpus
    rng = random.Random(3)
    extra = [(10**6 + i, rng.choice(("", " ", "\n")).join(["".join(rng.choice("ab #|\n\t") for _ in range(rng.randrange(60)))] * rng.randrange(1, 4)))
             for i in range(120)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    trusted = labels.where("quality = 1")
    rows = rule_rows(quality_rules.rules(both, trusted))
    good = {r.doc_id for r in trusted.collect()}
    # the ratio by other means: JVM hashes looked up, counts and sums in Python
    grams = {r.doc_id: r.g for r in quality_rules.hashed(both, "text").select(
        "doc_id", F.transform(F.concat("_h", "_h2"), lambda x: F.pmod(x, F.lit(quality_rules.BUCKETS))).alias("g")).collect()}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    share, a = sum(target.values()) / sum(raw.values()), quality_rules.SMOOTHING
    weight = {b: math.log((target[b] + a * share) / ((raw[b] + a) * share)) for b in raw}
    for r in rows:
        want = base_brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        g = grams[r.doc_id]
        llr = sum(weight[b] for b in g) / len(g) if g else 0.0
        assert len(g) == max(0, 2 * want[0] - 1) and abs(r.llr - llr) < 1e-9
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and r.llr >= quality_rules.THRESHOLD)


def test_rules_keep_clean_and_reject_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = labels.where("quality = 1 AND doc_id % 2 = 0")  # judged on labels it has not seen
    r = quality_rules.rules(docs, half).join(labels.where("doc_id % 2 = 1").select("doc_id", F.col("quality").alias("label")), "doc_id")
    r = r.where("quality.n_words >= 10").groupBy("label").agg(F.avg(F.col("quality.kept").cast("int")).alias("kept")).collect()
    kept = {x.label: x.kept for x in r}
    assert kept[1] >= 0.98 and kept[0] <= 0.5


def test_rules_edges(edges, nothing):
    none = edges.select("doc_id").limit(0)
    out = quality_rules.rules(edges, none)  # no trusted text: all weights zero
    assert sorted(out.columns) == sorted(edges.columns) and dict(out.dtypes)["quality"].startswith("struct")
    rows = rule_rows(out)
    assert len(rows) == len(EDGES) and all(r.llr == 0.0 for r in rows)
    assert {r.base_failed for r in rows if r.n_words == 0} == {True}
    assert [tuple(r)[2:7] for r in sorted(rows, key=repr)] == [base_brute(r.text) for r in sorted(rows, key=repr)]
    assert quality_rules.rules(nothing, none).count() == 0


def test_bpe_like_the_library():
    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    merger, rng = bpe.Merger(ranks), random.Random(2)
    alphabet = "aab's 's'll'd're 've'm'tXé1２ \n\t  !?...ßñ漢字😀́'\"    "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += [None, "", "a" * 3000, "ab" * 700 + "!" * 900, " " * 3000 + "x", "\n\n", "<|endoftext|>"]
    ids, offsets, bounds = bpe.encode_texts(pa.array(texts), merger)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode_ordinary(t or ""), repr(t)


def test_bpe_round_trip_and_offsets(edges, nothing):
    encoded = bpe.encode(edges, RANKS)
    spell = bpe.Spelling(bpe.read_ranks(open(RANKS, "rb").read()))
    rows = bpe.decode(encoded, RANKS).collect()
    assert sorted(r.decoded for r in rows) == sorted((t or "").encode() for _, t, _, _ in EDGES)
    for r in rows:
        ends = [len(b"".join(spell[x] for x in r.ids[:k + 1])) for k in range(min(len(r.ids), 50))]
        assert r.token_ends[:50] == ends and (not r.ids or r.token_ends[-1] == len(r.decoded))
    assert bpe.decode(bpe.encode(nothing, RANKS), RANKS).count() == 0


def test_bpe_decode_null_and_clash(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [], "y"), (3, [31373, 995], "z")], "doc_id long, ids array<int>, decoded string")
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()} == {1: b"", 2: b"", 3: b"hello world"}


def test_licences(spark, edges, nothing):
    known = licences.known_digests(spark)
    mit = licences.KNOWN[0][1]
    docs = spark.createDataFrame([
        (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("\n", "  \n")), (2, mit + "\nmore"), (3, "released under the mit licence"),
        (4, "text\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0!\ntext"), (5, "Copyright 2020 x"), (6, None),
        (4, "text\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0!\ntext")], "doc_id long, text string")
    got = sorted((r.doc_id, r.whole_licence, r.licences, r.n_units) for r in licences.scan(docs, known).collect())
    assert got[0] == (1, "MIT", "MIT", 2) and got[2][:3] == (3, "MIT", "MIT")
    assert got[1] == (2, None, "", 0)  # a text that only contains one is not one
    assert got[3] == got[4] == (4, None, "Apache-2.0,CC-BY-NC-4.0", 2) and got[5:] == [(5, None, "", 0), (6, None, "", 0)]
    assert licences.scan(edges, known).count() == len(EDGES) and licences.scan(nothing, known).count() == 0


def test_licences_canonicalise_candidates_once(spark, tmp_dir):
    """One plan reads the texts' units, and asks no unit's digest whether it is null: that would canonicalise every unit."""
    spark.createDataFrame([(1, "SPDX-License-Identifier: MIT\nx\nSPDX-License-Identifier: MIT"), (1, "x"), (2, None)] * 2,
                          "doc_id long, text string").write.parquet(f"{tmp_dir}/docs")
    found = licences.scan(spark.read.parquet(f"{tmp_dir}/docs"), licences.known_digests(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Generate" in line and "whole" in line for line in plan) == 1
    assert not [line for line in plan if "Filter" in line and "unit" in line]
    assert sorted((r.doc_id, r.licences, r.n_units) for r in found.collect()) == [(1, "", 0)] * 2 + [(1, "MIT", 2)] * 2 + [(2, "", 0)] * 2


def test_licences_as_published(spark):
    isc = """ISC License

Copyright (c) 2020, Some Body

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
    mit = licences.KNOWN[0][1].replace("\n\n", "\0").replace("\n", " ").replace("\0", "\n\n")
    wrapped = mit.replace("above copyright", "above\ncopyright").replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS")
    docs = spark.createDataFrame([
        (1, isc), (2, isc.replace("\n", "\r\n")), (3, isc.split("\n", 2)[2]), (4, "MIT License\n\nCopyright 2021 A B\n\n" + wrapped),
        (5, "© A B\n" + wrapped), (6, "MIT License"), (7, "(c) A B\n\nother\n" + wrapped)], "doc_id long, text string")
    got = {r.doc_id: r.whole_licence for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    assert got == {1: "ISC", 2: "ISC", 3: "ISC", 4: "MIT", 5: "MIT", 6: None, 7: None}


def test_filter_on_the_verdict_computes_nothing_twice(spark, edges):
    """The plan that keeps rows hashes no more often than the plan that judges them."""
    trusted = spark.createDataFrame([(1,), (6,)], "doc_id long")
    judged, kept = quality_rules.rules(edges, trusted), quality_rules.kept(edges, trusted)
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    for call in ("xxhash64(", "split("):
        assert 0 < plan(kept).count(call) <= plan(judged).count(call)
    want = [r for r in judged.collect() if r["quality"].kept]
    assert kept.columns == edges.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in want)


def test_many_licences_under_other_wraps(spark):
    """Every full text and notice, wrapped at other widths, titled, with its copyright line, is found as itself."""
    import textwrap

    rows, want = [], {}
    full = [(i, t) for i, t in licences.KNOWN if len(t) > 150]
    assert len({i for i, _ in full}) >= 14 and len({i for i, _ in licences.KNOWN}) >= 18
    for n, (name, text) in enumerate(full):
        for k, width in enumerate((60, 72, 100)):
            body = "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))
            title = licences.TITLES.get(name, [""])[0]
            whole = f"{title}\n\nCopyright (c) 20{k}0 Some Body\n\n{body}\n" if title else f"Copyright 20{k}0 Some Body\n\n{body}"
            rows.append((10 * n + k, whole))
            want[10 * n + k] = name
    rows += [(9000 + n, f"intro\n\nSPDX-License-Identifier: {name}\n\nmore") for n, name in enumerate(("Zlib", "BSD-3-Clause"))]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.known_digests(spark)).collect()}
    assert {i: got[i].whole_licence for i in want} == want
    assert (got[9000].licences, got[9001].licences, got[9000].whole_licence) == ("Zlib", "BSD-3-Clause", None)


def test_mixing_meets_marginals(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(5, 40)) + rng.choice(("", " a@b", " | x")), rng.choice("aab"), rng.choice(["en", "de"]))
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"a": 0.4, "b": 0.6}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"contact": 0.3, "table": 0.3, "prose": 0.4}}
    got = {(r.dimension, r.category): r for r in mixing.report(docs, targets).collect()}
    assert len(got) == 7
    for name, shares in targets.items():
        for category, want in shares.items():
            r = got[name, category]
            assert r.reachable and abs(r.goal_share - want) < 1e-9 and abs(r.expected_share - want) <= 2 * mixing.TOLERANCE


def test_mixing_reaches_what_can_be_reached(spark):
    """Production parameters: every category gets its target, or all it has."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.report(docs).collect()
    held = sum(r.tokens for r in rows if r.dimension == "lang")
    for r in rows:
        assert abs(r.expected_share - r.goal_share) <= 2 * mixing.TOLERANCE, r
        if not r.reachable:
            assert abs(r.goal_share - r.tokens / (mixing.KEEP_SHARE * held)) < 1e-9 and r.goal_share < r.asked_share
        elif r.dimension == "lang":
            assert abs(r.goal_share - mixing.TARGETS["lang"][r.category]) < 1e-9
    assert {r.category for r in rows if not r.reachable} == {"contact", "licensed", "table"}
    # the sample itself: the coins' tokens are near the expected ones
    taken = mixing.sampled(docs).where("mix.kept").groupBy("lang").agg(F.sum("mix.n_tokens").alias("n")).collect()
    total = sum(r.n for r in taken)
    want = {r.category: r.expected_share for r in rows if r.dimension == "lang"}
    assert abs(total / (0.5 * held) - 1) < 0.1 and all(abs(r.n / total - want[r.lang]) < 0.05 for r in taken)


def test_mixing_caps_inside_the_rake(spark):
    """A category that its target asks more of than there is is kept whole;
    the others share the rest in proportion to their targets."""
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 10 else "b" if i < 60 else "c", "en") for i in range(160)],
                                 "doc_id long, text string, source string, lang string")
    got = {r.category: r for r in mixing.report(docs, {"source": {"a": 0.4, "b": 0.2, "c": 0.4}}).collect()}
    assert not got["a"].reachable and abs(got["a"].expected_share - 0.125) < 1e-6
    assert abs(got["b"].expected_share - 0.875 / 3) < 2e-3 and abs(got["c"].expected_share - 2 * 0.875 / 3) < 2e-3
    kept = mixing.sampled(docs, {"source": {"a": 0.4, "b": 0.2, "c": 0.4}}).where("mix.kept").where("source = 'a'").count()
    assert kept == 10


def test_mixing_edges(edges, nothing):
    out = mixing.sampled(edges)
    assert sorted(out.columns) == sorted(edges.columns)
    rows = out.select("doc_id", "mix.*").collect()
    assert len(rows) == len(EDGES) and all(0 < r.probability <= 1 for r in rows)
    assert len({(r.kept, r.probability) for r in rows if r.doc_id == 2}) == 1
    assert mixing.sampled(nothing).count() == 0


def test_classifier_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert wins >= 0.95 and ((s >= 0.7) == y)[y == 1].mean() >= 0.95
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_classifier_sample_is_bounded_in_bytes(spark, monkeypatch):
    """Long texts make a smaller sample: whole rows, taken in order until the budget is used up."""
    rng = random.Random(5)
    long = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000)) if i % 2 else "short text", i % 3 // 2) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in long], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in long], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(quality_classifier, "train", lambda examples: taken.append(examples))
    for budget in (10**9, 2_000_000, 0):
        quality_classifier.fit(docs, labels, sample_bytes=budget)
    sizes = [sum(b.nbytes + w.nbytes for _, b, w in x) for x in taken]
    assert len(taken[0]) > 80 and sizes[0] > 4_000_000 and 1_000_000 < sizes[1] <= 2_000_000 and len(taken[2]) == 0
    few = {b.tobytes() for _, b, _ in taken[1]}
    assert few < {b.tobytes() for _, b, _ in taken[0]}


def test_classifier_edges(spark, edges, nothing, corpus):
    labels = corpus[1]
    rows = quality_classifier.classify(edges, labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1  # the bias alone
    assert quality_classifier.classify(nothing, labels).count() == 0
    assert quality_classifier.classify(edges, labels.limit(0)).count() == len(EDGES)


def test_digest_of_ids_is_the_contract(spark, corpus):
    from cohortwise.llm import registry

    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in registry.op4_byte_bpe(spark, SF).collect()}
    for r in corpus[0].collect():
        ids = library.encode_ordinary(r.text or "")
        x = got[r.doc_id]
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
