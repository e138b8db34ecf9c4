"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortwise.llm import exact_dedup, near_dedup, substring_dedup
from cohortwise.llm.components import connected
from tests.llm.cases import EDGES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def near_brute(rows):
    low = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and both:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_workers_hold_and_keep_little(monkeypatch):
    """Signatures of 4 MB of texts take some arrays of a slice, not of them all; each kind of task ends by giving Arrow's free memory back."""
    import tracemalloc

    import pyarrow as pa

    class Pool:
        given = 0

        def release_unused(self):
            Pool.given += 1

    texts = [" ".join(f"w{n}x{i}" for i in range(1300)) for n in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts)], names=["_id", "_text"])
    assert batch.nbytes > 3_500_000
    tracemalloc.start()
    rows = sum(b.num_rows for b in near_dedup._signatures(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 400 and peak < 80e6, peak
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    tasks = [near_dedup._signatures, near_dedup._forests, near_dedup._with_open_pairs, near_dedup._exact_links, near_dedup._confirm,
             near_dedup._branched]
    for n, task in enumerate(tasks):
        assert list(task(iter([]))) == [] and Pool.given == n + 1


def copies(rng, n, groups, edits):
    """Groups of texts with a few words changed, and unrelated texts."""
    rows = []
    for i in range(n):
        words = [f"t{rng.randrange(10**6)}" for _ in range(rng.randrange(30, 90))]
        rows.append(words)
    for size in groups:
        base = [f"g{rng.randrange(10**6)}" for _ in range(80)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
            rows.append(own)
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def test_exact_edges(edges):
    got = exact_dedup.groups(edges).collect()
    assert len(got) == len(EDGES)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in empty) == [
        (False, 3, 3, 3, True), (False, 4, 3, 3, False), (True, 0, 3, 3, False)]
    same = by[hashlib.sha256(b"one two three four five six").hexdigest()]
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in same} == {(1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False)}
    assert all(sum(r.kept for r in g) == 1 for g in by.values())
    kept = exact_dedup.deduplicate(edges)
    assert kept.columns == edges.columns and kept.count() == len(by)


def test_exact_repeated_row_stays_once(spark):
    docs = docs_of(spark, [(5, "a  b")] * 3 + [(7, "a b")])
    got = exact_dedup.groups(docs).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [(5, 5, 4)] * 3 + [(7, 5, 4)]
    assert sum(r.kept for r in got) == 1 and exact_dedup.deduplicate(docs).count() == 1


def test_exact_ids_all_null(spark):
    got = exact_dedup.groups(docs_of(spark, [(None, "x"), (None, "x")])).collect()
    assert [r.keep_id for r in got] == [None, None] and sum(r.kept for r in got) == 1


@pytest.mark.parametrize("operator", [exact_dedup.groups, exact_dedup.deduplicate, near_dedup.classes, near_dedup.deduplicate,
                                      substring_dedup.remove_repeats])
def test_empty_table(nothing, operator):
    assert operator(nothing).count() == 0


def test_near_edges(edges):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.classes(edges).collect()), key=repr)
    assert len(got) == len(EDGES)
    by = {r[0]: r[1:] for r in got if r[0] is not None}
    assert by[3] == (0, 3, True) and by[4] == (0, 4, True) and by[5] == (0, 5, True)  # nothing to compare: linked with nothing
    assert by[1] == (2, 1, True) and by[2] == (2, 1, False)
    assert by[7][1:] == (6, False) and by[9] == (1, 8, False)  # the long texts; fewer words than a shingle
    assert all(r[2:] == (None, True) for r in got if r[0] is None)
    assert near_dedup.deduplicate(edges).columns == edges.columns


def test_near_against_brute_force(spark):
    rows = copies(random.Random(5), 150, (2, 3, 25, 60), 9)
    want = near_brute(rows)
    got = near_dedup.classes(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_large_nodes_branch_and_fall_back(spark, monkeypatch):
    """Nodes far beyond the leaf size: blocks, branching, block against block."""
    monkeypatch.setattr(near_dedup, "LEAF", 8)
    monkeypatch.setattr(near_dedup, "DEPTH", 1)
    rows = copies(random.Random(6), 40, (70,), 14)
    want = near_brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.classes(docs_of(spark, rows)).collect()}
    assert got == want


def test_near_threshold_pairs_survive_large_nodes():
    """Isolated pairs at similarity 0.75 whose nodes are large on every level still share one."""
    import pyarrow as pa

    n = 1500
    texts = [" ".join([f"p{i}c{k}" for k in range(64)] + [f"p{i}{side}{k}" for k in range(10)]) for i in range(n) for side in "ab"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * n)), pa.array(texts)], names=["_id", "_text"])
    paths, tokens = [], []
    for out in near_dedup._signatures([batch]):
        paths += out.column(4).to_pylist()
        tokens += out.column(3).to_pylist()
    rows = {(node, i) for i, own in enumerate(paths) for node in own}
    for _ in range(near_dedup.DEPTH + 1):
        rows = sorted((node, i) for node, i in rows if (node, i ^ 1) in rows)
        assert n - len({i // 2 for _, i in rows}) <= 1
        ids = pa.array([i for _, i in rows])
        level = pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows]), ids, ids, pa.array([tokens[i] for _, i in rows])],
                                           names=["node", "rep", "comp", "tokens"])
        rows = {x for out in near_dedup._branched([level]) for x in zip(out.column(0).to_pylist(), out.column(1).to_pylist())}


def test_near_copies_in_large_nodes_are_not_branched(spark, monkeypatch):
    """The children of a node of near copies are as large as the node: its texts are compared where they are, once."""
    monkeypatch.setattr(near_dedup, "LEAF", 16)
    names, write = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: names.append(name) or write(df, name))
    rows = copies(random.Random(8), 40, (90,), 8)
    want = near_brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.classes(docs_of(spark, rows)).collect()}
    assert got == want
    assert "mixed" in names and "children" not in names and names.count("open") == 1, names


def test_near_pairs_meet_once_and_by_all_their_tokens():
    """Pairs that met in an earlier leaf stay out of later ones, with or without bits; the shortcut by lowest bits loses no pair."""
    import numpy as np

    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 16, near_dedup.TOKENS)
    tokens = np.where(rng.random((150, near_dedup.TOKENS)) < 0.77, base, rng.integers(0, 1 << 16, (150, near_dedup.TOKENS))).astype(np.uint16)
    near = np.array([(tokens == t).sum(axis=1) >= 0.6 * near_dedup.TOKENS for t in tokens])
    assert 0.2 < near.mean() < 0.8 and (near_dedup._near(tokens, tokens) == near).all()
    spread = np.concatenate([tokens, rng.integers(0, 1 << 16, (1500, near_dedup.TOKENS)).astype(np.uint16)])
    assert (near_dedup._near(spread, tokens)[:150] == near).all()
    comps, blocks = np.arange(150), np.zeros(150, np.int64)
    lists = [sorted({i % 7, 100 + i % 5}) for i in range(150)]
    earlier = np.concatenate(lists), np.arange(151) * 2
    met = np.array([[bool({*x} & {*y}) for y in lists] for x in lists])
    for limit in (near_dedup.BITS, 0):
        near_dedup.BITS, kept = limit, near_dedup.BITS
        try:
            got = near_dedup._open_pairs(tokens, comps, blocks, earlier)
        finally:
            near_dedup.BITS = kept
        assert (got == np.triu(near & ~met, 1)).all()
    across = near_dedup._open_pairs(tokens, comps, np.arange(150) % 2, (np.zeros(0, np.int64), np.zeros(151, np.int64)))
    assert (across == np.triu(near & ((np.arange(150)[:, None] + np.arange(150)) % 2 == 1), 1)).all()
    values, bounds = near_dedup.per_text_unique(rng.integers(0, 900, 6000).astype(np.uint64), np.arange(0, 6001, 100))
    others = np.arange(1, 60)
    bits = near_dedup._bits(values, bounds)
    want = [len({*values[bounds[0]:bounds[1]]} & {*values[bounds[j]:bounds[j + 1]]}) for j in others]
    assert near_dedup._in_both(0, others, values, bounds, bits).tolist() == want
    assert near_dedup._in_both(0, others, values, bounds, None).tolist() == want


def test_near_on_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = near_brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.classes(docs).collect()} == want


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)]
    got = {r.id: r.comp for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def substring_brute(rows):
    words, first = {}, {}
    for i, t in sorted(rows):
        words[i] = WORD.findall(t or "")
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        cover = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                cover.update(range(k, k + 13))
        out[i] = (len(w), len(cover), " ".join(x for k, x in enumerate(w) if k not in cover))
    return out


def test_substring_against_brute_force(spark):
    rng = random.Random(7)
    passages = [[f"p{rng.randrange(10**5)}" for _ in range(rng.choice((12, 13, 14, 20, 60)))] for _ in range(12)]
    rows = []
    for i in range(160):
        words = []
        for _ in range(rng.randrange(6)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(9))]
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            words += p if rng.random() < 0.6 else p[cut:] if rng.random() < 0.5 else p[:cut]
        rows.append((i * 3, rng.choice(("", " ", "\n")) + rng.choice((" ", "\t", " \r\n")).join(words)))
    rows += [(1, " ".join(["same"] * 40)), (4, " ".join(["same"] * 30)), (7, None), (10, "")]
    want = substring_brute(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 1000


def test_substring_edges(edges):
    got = substring_dedup.remove_repeats(edges).collect()
    assert len(got) == len(EDGES)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_words, r.n_removed))
    assert by[6] == [(40_000, 0)] and by[7] == [(40_001, 40_000)]
    assert sorted(by[None]) == [(0, 0), (6, 0)] and by[2] == [(6, 0), (6, 0)] and by[3] == [(0, 0)]


def test_packing_round_trip():
    import numpy as np

    for values in ([], [0], [5, 3, 2**63, 2**64 - 1], list(range(1000))):
        x = np.array(values, np.uint64)
        assert (substring_dedup.unpacked(substring_dedup.packed(x)) == x).all()
    for values in ([], [-5], [2**63 - 1, -2**63, 0], [7, 3, 3]):
        x = np.array(values, np.int64)
        assert (substring_dedup.unpacked_signed(substring_dedup.packed_signed(x)) == x).all()


def test_hot_window_is_one_entry_per_slice(spark):
    """A window that a third of all rows share, many times each: a slice sends
    it once, so what meets in its bucket grows with the slices, not the rows."""
    import numpy as np
    import pyarrow as pa

    hot = " ".join(f"hot{k}" for k in range(13))
    texts = [f"{hot} own{i} {hot} x{i}" if i % 3 == 0 else f"plain{i} words{i} of{i} no{i} one{i} a{i} b{i} c{i}" for i in range(900)]
    ids = np.arange(900)
    parts = [substring_dedup.Slice(substring_dedup._slice_row(k, ids[k::3], pa.array(texts[k::3])), 4) for k in range(3)]
    held = [p.anchors()[0] for p in parts]
    assert all(len(np.unique(x)) == len(x) for x in held) and len(held[0]) < 300 * 12 * 2
    first, _, least, cuts, entry, at = parts[0].windows(None)
    times = np.bincount(entry)
    assert len(first) == len(times) and sorted(times)[-2:] == [1, 600] and least[times.argmax()] == 0  # the hot one, once
    rows = list(enumerate(texts))
    want = substring_brute(rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text)
           for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)).collect()}
    assert got == want and sum(x[1] for x in want.values()) == 299 * 26


def test_substring_many_slices_and_negative_ids(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(300)}" for _ in range(4000)]
    rows = []
    for i in range(240):
        at, n = rng.randrange(3900), rng.randrange(5, 60)
        rows.append((rng.randrange(-10**12, 10**12) if i % 2 else i - 100, " ".join(base[at:at + n] + [f"u{i}"] + base[at // 2:at // 2 + n])))
    want = substring_brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts, buckets in ((1, 1), (40, 7)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(df.repartition(parts), buckets=buckets).collect()}
        assert got == want


def test_texts_are_shuffled_once(spark):
    df = substring_dedup.remove_repeats(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the slices twice more, and the first answers
    assert plan.count("ReusedExchange [slice") == 3 and plan.count("MapInArrow pack") == 1


def test_spark_only_moves_bounded_groups(spark):
    """A group of equal texts leaves the first stage in at most ``SALTS`` rows a task."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("all the same").alias("text")).repartition(2)
    out = exact_dedup.groups(docs)
    assert out.where("kept").count() == 1 and out.agg(F.max("group_size")).first()[0] == 3000
