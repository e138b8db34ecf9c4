"""Hard negatives: the curve, the bounds, the search against brute force, edges."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_hilbert_steps_to_a_neighbour(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hn.hilbert(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_met():
    rng = np.random.default_rng(2)
    box = rng.integers(-50, 50, (40, 6))
    low, high = box.min(0)[None], box.max(0)[None]
    a = rng.integers(-50, 50, (30, 6)).astype(np.int32)
    least, most = hn.bounds(a, low.astype(np.int32), high.astype(np.int32))
    scores = a.astype(np.int64) @ box.T
    assert (scores >= least).all() and (scores <= most).all()
    corners = np.where(a > 0, high, low)
    assert ((a.astype(np.int64) * corners).sum(1) == most[:, 0]).all()


def test_products_beyond_floats():
    a = np.full((1, 40), hn.LARGEST - 1, np.int32)
    assert int(hn.products(a, a)[0, 0]) == 40 * (hn.LARGEST - 1) ** 2


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95):
    seen, live = set(), []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(
                v is None or not math.isfinite(v) or abs(v) >= hn.LARGEST / 256 for v in x):
            continue
        q = tuple(math.floor(256 * float(np.float32(v))) for v in x)
        if (i, label, q) not in seen:
            seen.add((i, label, q))
            live.append((i, label, q))
    out = []
    for k, (i, label, q) in enumerate(live):
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), j, m) for n, (j, m, p) in enumerate(live) if n != k]
        for score, pos, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fit = sorted(s for s in scored if s[2] != label and low * -score <= 100 * -s[0] <= high * -score)
            out += [(i, pos, r, neg, -score, -s) for r, (s, neg, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, step=5, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % step == 0, **kw).collect())


def vectors(rng, n, dims=8, labels=3, grain=64):
    return [(i, rng.randrange(labels), [rng.randrange(-grain, grain) / grain for _ in range(dims)]) for i in range(n)]


@pytest.fixture()
def small_blocks(monkeypatch):
    """Many blocks, pages, groups and units on few rows."""
    for name, value in (("BLOCK", 16), ("ANCHORS", 7), ("PAGE", 3), ("PART", 4)):
        monkeypatch.setattr(hn, name, value)


def test_equals_brute_force(spark, small_blocks):
    rows = vectors(random.Random(1), 260)
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 300 and mined(spark, rows) == want


def test_ties_hot_label_and_copies(spark, small_blocks):
    rng = random.Random(2)
    base = [rng.randrange(-3, 4) / 4 for _ in range(4)]
    # coarse values: many equal scores; a third of all rows are one vector; a label holds most rows
    rows = [(i, 0 if i % 4 else 1, base if i % 3 == 0 else [rng.randrange(-2, 3) / 2 for _ in range(4)]) for i in range(150)]
    rows += rows[:40]
    rows += [(7, 1, [0.5] * 4), (7, 0, [1.0] * 4), (10, 0, [1.0] * 4)]  # ids of several rows
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want


def test_parameters(spark, small_blocks):
    rows = vectors(random.Random(3), 120, labels=2)
    kw = {"positives": 2, "negatives": 4, "low_percent": 0, "high_percent": 80}
    want = brute(rows, lambda i: i % 5 == 0, 2, 4, 0, 80)
    assert want and mined(spark, rows, **kw) == want


def test_zone_maps_choose(spark, monkeypatch):
    """Tight clusters: only blocks that can reach a window are read."""
    for name, value in (("BLOCK", 16), ("PART", 4)):
        monkeypatch.setattr(hn, name, value)
    rng = random.Random(4)
    rows = []
    for i in range(640):
        v = [0.0] * 10
        v[i % 10] = 1.0
        rows.append((i, i // 10 % 2, [x + rng.randrange(-4, 5) / 256 for x in v]))
    read = []
    real = hn.scanned
    monkeypatch.setattr(hn, "scanned", lambda pairs, *a: read.append(pairs.count()) or real(pairs, *a))
    want = brute(rows, lambda i: i % 320 == 0, high=100)
    assert mined(spark, rows, 320, high_percent=100) == want and want
    assert sum(read) < 2 * 40 / 2  # two searches over 40 blocks


def test_rows_that_take_no_part(spark, nothing):
    rows = vectors(random.Random(5), 60)
    odd = [(100, None, [1.0] * 8), (105, 1, None), (110, 1, [float("nan")] + [1.0] * 7), (115, 0, [float("inf")] * 8), (None, 1, [1.0] * 8),
           (120, 0, [None] + [1.0] * 7), (125, 0, [1e6] * 8), (130, 1, []), (135, 0, [1.0, 1.0]), (140, 2, [0.25] * 20)]
    want = brute([(i, m, (x or []) + [0.0] * (20 - len(x)) if x is not None else None) for i, m, x in rows + odd], lambda i: i % 5 == 0)
    assert mined(spark, rows + odd) == want
    assert mined(spark, odd[:6]) == [] and hn.mine(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    clash = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA + ", row int, block string, q int, id int")
    assert sorted(map(tuple, hn.mine(clash, F.col("vec_id") % 5 == 0).collect())) == brute(rows, lambda i: i % 5 == 0)
    alone = [(0, 1, [1.0]), (5, 2, [1.0])]
    assert mined(spark, alone) == []
