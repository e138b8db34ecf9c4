"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become integers, and all rows are put in the order of label and of a
Hilbert curve through their widest dimensions. Runs of ``BLOCK`` rows of this
order are the rows of a Parquet table; each block has a zone map, the least
and greatest value of every dimension. With interval arithmetic a zone map
bounds the inner product of an anchor with every row of the block from both
sides, so a block is read only for anchors one of whose score windows it may
reach, and only if it may hold something better than what is known already.

Two searches run that way, first for the positives (one open window per
anchor), then for the negatives (one window per positive). Each starts with
one promising block per anchor, the home block or the one whose bounds lie
nearest to the windows, which lifts the windows' lower ends; the zone maps then
choose the blocks still to be read. Nothing is approximate.

Anchors are handled ``ANCHORS`` at a time, zone maps ``PAGE`` blocks at a
time, blocks ``PART`` to a unit of work: blocks and anchors are counted out
exactly, so no label, however hot, makes a group of another size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.llm.sharding import numbered
from cohortwise.llm.storage import written

BLOCK, ANCHORS, PAGE, PART = 1024, 1024, 512, 64
#: The curve goes through this many dimensions with so many bits each; together at most 63.
CURVE_DIMS, CURVE_BITS = 9, 7
#: Integers of this magnitude do not fit exact scores.
LARGEST = 1 << 24
NEVER = 1 << 62

OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "row long, slot int, score long, id long, other long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (unsigned, below
    2 ** bits): reflections and swaps undone from the highest bit down, the
    result Gray-coded and interleaved."""
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(len(x)):
            set_ = (x[i] >> np.uint64(bit)) & one == 1
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(set_, low, swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(bit)) & one == 1, np.uint64((1 << bit) - 1), np.uint64(0))
    key = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | (((axis ^ turn) >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: by floating point while every sum stays below 2 ** 53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each vector with any point of each box."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _list_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, short rows filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    flat = np.asarray(column.flatten()).astype(np.int32)
    out = np.zeros((len(column), width), np.int32)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _matrix(binary: bytes, width: int) -> np.ndarray:
    return np.frombuffer(binary, np.int32).reshape(-1, width)


def _longs(binary: bytes) -> np.ndarray:
    return np.frombuffer(binary, np.int64)


def usable(vectors: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``id, label, q, anchor`` of the rows that take part; ``q``: floor(256 x)."""
    q = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    fits = F.coalesce(F.forall(F.col(vector_col), lambda x: F.coalesce(
        F.abs(x.cast("double")) < F.lit(LARGEST / 256.0), F.lit(False))), F.lit(False))
    rows = vectors.where(fits & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                       q.cast("array<int>").alias("q"), F.coalesce(anchors, F.lit(False)).alias("anchor"))


def _moments(batches):
    """(dim, n, total, squares) of a batch."""
    for batch in batches:
        if batch.num_rows:
            width = int(np.asarray(batch.column(0).value_lengths()).max())
            q = _list_matrix(batch.column(0), width).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"dim": np.arange(width, dtype=np.int32), "n": np.full(width, len(q), np.int64),
                                              "total": q.sum(0), "squares": (q * q).sum(0)})


def ordered(rows: DataFrame) -> tuple[DataFrame, int]:
    """(``row, block, id, label, vector, anchor`` in the order of label and
    curve, dimensions). Rows alike in all columns are one."""
    moments = rows.select("q").mapInArrow(_moments, "dim int, n long, total double, squares double").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares")).orderBy("dim").collect()
    width = len(moments)  # one row per dimension
    if not width:
        return rows.sparkSession.createDataFrame([], "row long, block long, id long, label long, vector binary, anchor boolean"), 0
    mean = np.array([m["total"] / m["n"] for m in moments])
    spread = np.sqrt(np.maximum(np.array([m["squares"] / m["n"] for m in moments]) - mean**2, 0))
    axes = np.argsort(-spread, kind="stable")[:CURVE_DIMS]
    start, step = (mean - 3 * spread)[axes], np.maximum(6 * spread[axes], 1.0) / (1 << CURVE_BITS)

    def placed(batches):
        for batch in batches:
            q = _list_matrix(batch.column(2), width)
            cells = np.clip((q[:, axes] - start) / step, 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hilbert(cells.astype(np.uint64), CURVE_BITS)),
                 pa.array([x.tobytes() for x in q], pa.binary()), batch.column(3)], names=["id", "label", "curve", "vector", "anchor"])

    curve = rows.select("id", "label", "q", "anchor").mapInArrow(
        placed, "id long, label long, curve long, vector binary, anchor boolean")
    single = curve.groupBy("label", "curve", "id", "vector").agg(F.max("anchor").alias("anchor"))
    dealt, _ = numbered(single, [F.col("label"), F.col("curve"), F.col("id"), F.col("vector")])
    return dealt.select(F.col("row_number").alias("row"), F.floor(F.col("row_number") / F.lit(BLOCK)).alias("block"),
                        "_row.id", "_row.label", "_row.vector", "_row.anchor"), width


def blocks_of(rows: DataFrame, width: int) -> DataFrame:
    """The block table: ids, labels and vectors of ``BLOCK`` rows, by id, and their zone map."""

    def pack(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["row"].to_numpy(), table["id"].to_numpy()))  # equal scores: smaller ids first
        row, ids, labels = (table[c].to_numpy()[order] for c in ("row", "id", "label"))
        q = _matrix(b"".join(table["vector"].to_pylist()), width)[order]
        return pa.table({"block": [int(row.min()) // BLOCK], "least_label": [int(labels.min())], "most_label": [int(labels.max())],
                         **{name: pa.array([x.tobytes()], pa.binary()) for name, x in (
                             ("rows", row), ("ids", ids), ("labels", labels), ("vectors", q), ("low", q.min(0)), ("high", q.max(0)))}})

    return rows.groupBy("block").applyInArrow(pack, "block long, least_label long, most_label long, rows binary, ids binary, "
                                                    "labels binary, vectors binary, low binary, high binary")


def pages_of(blocks: DataFrame) -> DataFrame:
    """The zone maps of ``PAGE`` blocks as one row."""

    def pack(table: pa.Table) -> pa.Table:
        join = {name: b"".join(table[name].to_pylist()) for name in ("low", "high")}
        longs = {name: table[name].to_numpy().astype(np.int64).tobytes() for name in ("block", "least_label", "most_label")}
        return pa.table({"page": [int(table["block"][0].as_py()) // PAGE],
                         **{name: pa.array([x], pa.binary()) for name, x in {**longs, **join}.items()}})

    zones = blocks.select("block", "least_label", "most_label", "low", "high", F.floor(F.col("block") / F.lit(PAGE)).alias("_page"))
    return zones.groupBy("_page").applyInArrow(
        pack, "page long, block binary, least_label binary, most_label binary, low binary, high binary")


def packed_anchors(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """``ANCHORS`` anchors as one row, with their score windows (arrays ``lows``
    and ``highs``, one length for all) from ``windows``."""

    def pack(table: pa.Table) -> pa.Table:
        def flat(name):
            return np.asarray(table[name].combine_chunks().flatten()).astype(np.int64).tobytes()
        return pa.table({"group": [table["group"][0].as_py()], "rows": pa.array([table["row"].to_numpy().tobytes()], pa.binary()),
                         "labels": pa.array([table["label"].to_numpy().tobytes()], pa.binary()),
                         "vectors": pa.array([b"".join(table["vector"].to_pylist())], pa.binary()),
                         "lows": pa.array([flat("lows")], pa.binary()), "highs": pa.array([flat("highs")], pa.binary())})

    joined = anchors.join(windows, "row").select("group", "row", "label", "vector", "lows", "highs")
    return joined.groupBy("group").applyInArrow(
        pack, "group long, rows binary, labels binary, vectors binary, lows binary, highs binary")


def _reach(batches, width: int, slots: int, same: bool):
    """Per row (anchors, page): (group, block numbers, lower and upper bounds, windows, rows), blocks without a fitting label cut out."""
    for batch in batches:
        for r in batch.to_pylist():
            vectors, labels = _matrix(r["vectors"], width), _longs(r["labels"])
            low, high = bounds(vectors, _matrix(r["low"], width), _matrix(r["high"], width))
            first, last = _longs(r["least_label"])[None, :], _longs(r["most_label"])[None, :]
            own = labels[:, None]
            fits = (first <= own) & (own <= last) if same else (first != own) | (last != own)
            yield (r["group"], _longs(r["block"]), low, high, fits, _longs(r["lows"]).reshape(-1, slots),
                   _longs(r["highs"]).reshape(-1, slots), _longs(r["rows"]))


def _met(anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """Every row of anchors with every page of zone maps, dealt by both."""
    last = max(pages.count() - 1, 0)
    asked = anchors.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("page"))
    return asked.join(pages.hint("shuffle_hash"), "page").repartition("group", "page").select(
        "group", "rows", "labels", "vectors", "lows", "highs", "block", "least_label", "most_label", "low", "high")


def chosen(anchors: DataFrame, pages: DataFrame, width: int, slots: int, same: bool) -> DataFrame:
    """(group, block): blocks that may reach a window of some anchor of the group."""

    def choose(batches):
        for group, numbers, low, high, fits, lows, highs, _ in _reach(batches, width, slots, same):
            need = np.zeros(low.shape, bool)
            for w in range(slots):
                need |= (high >= lows[:, w, None]) & (low <= highs[:, w, None])
            at = numbers[(need & fits).any(axis=0)]
            yield pa.RecordBatch.from_pydict({"group": np.full(len(at), group, np.int64), "block": at})

    return _met(anchors, pages).mapInArrow(choose, "group long, block long")


def nearest(anchors: DataFrame, pages: DataFrame, width: int, slots: int, same: bool) -> DataFrame:
    """(group, block): for every anchor the block the middle of whose bounds is nearest to its highest window's top."""

    def choose(batches):
        for group, numbers, low, high, fits, _, highs, rows in _reach(batches, width, slots, same):
            gap = np.abs((low + high) / 2 - highs.max(axis=1, initial=-NEVER)[:, None])
            gap = np.where(fits & (low <= highs.max(axis=1, initial=-NEVER)[:, None]), gap, np.inf)
            at = gap.argmin(axis=1)
            near = gap[np.arange(len(gap)), at]
            ok = np.isfinite(near)
            yield pa.RecordBatch.from_pydict({"row": rows[ok], "group": np.full(int(ok.sum()), group, np.int64),
                                              "gap": near[ok], "block": numbers[at[ok]]})

    found = _met(anchors, pages).mapInArrow(choose, "row long, group long, gap double, block long")
    best = found.groupBy("row", "group").agg(F.min(F.struct("gap", "block")).alias("best"))
    return best.select("group", F.col("best.block").alias("block")).distinct()


def scanned(pairs: DataFrame, anchors: DataFrame, blocks: DataFrame, parts: int, width: int, slots: int, keep: int,
            same: bool) -> DataFrame:
    """Reads the chosen blocks: the ``keep`` best rows of each unit of work for
    every anchor and window (``row, slot, score, id, other``)."""
    empty = F.lit(None).cast("binary")
    units = pairs.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)))
    there = units.join(blocks, "block").select(
        "group", "part", F.col("block").alias("at"), "rows", "ids", "labels", "vectors", empty.alias("lows"), empty.alias("highs"))
    here = units.select("group", "part").distinct().join(anchors, "group").select(
        "group", "part", F.lit(-1).cast("long").alias("at"), "rows", empty.alias("ids"), "labels", "vectors", "lows", "highs")
    dealt = here.unionByName(there).repartition("group", "part").sortWithinPartitions("group", "part", "at")

    def scan(batches):
        unit = None
        for batch in batches:
            for r in batch.to_pylist():
                if r["at"] < 0:  # the anchors of a unit come first
                    if unit is not None:
                        yield unit.best()
                    unit = _Unit(r, width, slots, keep, same)
                else:
                    unit.read(r)
        if unit is not None:
            yield unit.best()

    return dealt.mapInArrow(scan, FOUND)


class _Unit:
    """A group of anchors while blocks are read for it."""

    def __init__(self, r: dict, width: int, slots: int, keep: int, same: bool):
        self.rows, self.labels, self.vectors = _longs(r["rows"]), _longs(r["labels"]), _matrix(r["vectors"], width)
        self.lows, self.highs = _longs(r["lows"]).reshape(-1, slots).copy(), _longs(r["highs"]).reshape(-1, slots)
        self.width, self.slots, self.keep, self.same = width, slots, keep, same
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def read(self, r: dict) -> None:
        rows, ids, labels = _longs(r["rows"]), _longs(r["ids"]), _longs(r["labels"])
        scores = products(self.vectors, _matrix(r["vectors"], self.width)).astype(np.int64)
        fits = self.labels[:, None] == labels[None, :]
        fits = fits & (self.rows[:, None] != rows[None, :]) if self.same else ~fits
        scores = np.where(fits, scores, -NEVER)
        for w in range(self.slots):
            low, high = self.lows[:, w], self.highs[:, w]
            left = np.where((scores >= low[:, None]) & (scores <= high[:, None]), scores, -NEVER)
            who = np.flatnonzero((left > -NEVER).any(axis=1))
            left = left[who]
            for k in range(self.keep):
                if not len(who):
                    break
                at = left.argmax(axis=1)  # of equal scores the first, that is the smallest id
                best = left[np.arange(len(who)), at]
                some = best > -NEVER
                who, left, at, best = who[some], left[some], at[some], best[some]
                self.found.append((who, np.full(len(who), w), best, ids[at], rows[at]))
                self.held += len(who)
                left[np.arange(len(who)), at] = -NEVER
                if k == self.keep - 1:
                    self.lows[who, w] = np.maximum(self.lows[who, w], best)  # so many are at least as good
        if self.held > 1_000_000:
            self._reduce()

    def _reduce(self) -> None:
        who, slot, score, ids, other = (np.concatenate(x) for x in zip(*self.found)) if self.found else (np.zeros(0, np.int64),) * 5
        order = np.lexsort((other, ids, -score, slot, who))
        who, slot, score, ids, other = (x[order] for x in (who, slot, score, ids, other))
        new = np.r_[True, (who[1:] != who[:-1]) | (slot[1:] != slot[:-1])] if len(who) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        place = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
        top = place < self.keep
        self.found = [(who[top], slot[top], score[top], ids[top], other[top])]
        self.held = int(top.sum())

    def best(self) -> pa.RecordBatch:
        self._reduce()
        who, slot, score, ids, other = self.found[0]
        return pa.RecordBatch.from_pydict({"row": self.rows[who], "slot": slot.astype(np.int32), "score": score, "id": ids, "other": other})


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` per anchor and window, with their ``rank``; units hold at most ``keep`` each."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def search(anchors: DataFrame, windows: DataFrame, first: DataFrame | None, blocks: DataFrame, pages: DataFrame, parts: int,
           width: int, slots: int, keep: int, same: bool) -> DataFrame:
    """The best rows per anchor and window. ``first``: (group, block) to start with, else the nearest blocks."""
    before = written(packed_anchors(anchors, windows), "anchors")
    start = written(first if first is not None else nearest(before, pages, width, slots, same), "first-blocks")
    found = written(scanned(start, before, blocks, parts, width, slots, keep, same), "found")
    # windows rise to the last of ``keep`` found
    known = _best(found, keep).where(F.col("rank") == keep).select("row", "slot", F.col("score").alias("_least"))
    floors = known.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "_least"))).alias("_least"))  # one per slot
    risen = windows.join(floors, "row", "left").select("row", F.transform("lows", lambda x, i: F.greatest(
        x, F.coalesce(F.try_element_at("_least", i), x))).alias("lows"), "highs")
    after = written(packed_anchors(anchors, risen), "anchors")
    rest = written(chosen(after, pages, width, slots, same).join(start, ["group", "block"], "left_anti"), "blocks-to-read")
    more = written(scanned(rest, after, blocks, parts, width, slots, keep, same), "found")
    return written(_best(found.unionByName(more), keep), "best")


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` marks the anchors among the rows of ``vectors``. An anchor's
    positives are its ``positives`` best other rows of its label; for each,
    the ``negatives`` best rows of other labels with a score from
    ``low_percent`` to ``high_percent`` of the positive's are returned. Equal
    scores go by the smaller id.

    Rows with a null id, label, vector or component, with a component that is
    not finite or of magnitude 65,536 or more (scores would not be exact) take
    no part. Rows alike in id, label and vector count once; others that share
    an id are rows of their own. Vectors shorter than the longest go on with
    zeros. An anchor without positives, and a positive without negatives in
    its window, gives no row. An empty table gives an empty result; no other
    column is read.
    """
    spark = vectors.sparkSession
    rows, width = ordered(usable(vectors, anchors, id_col, label_col, vector_col))
    if not width:
        return spark.createDataFrame([], OUTPUT)
    rows = written(rows, "ordered")
    blocks = written(blocks_of(rows, width), "blocks")
    pages = written(pages_of(blocks), "zones")
    parts = max(-(-blocks.count() // PART), 1)
    counted, _ = numbered(rows.where("anchor"), [F.col("row")])
    some = written(counted.select(F.floor(F.col("row_number") / F.lit(ANCHORS)).alias("group"), "_row.row", "_row.block", "_row.id",
                                  "_row.label", "_row.vector"), "asked")

    def longs(*values: Column) -> Column:
        return F.array(*values).cast("array<long>")

    open_ = some.select("row", longs(F.lit(-NEVER + 1)).alias("lows"), longs(F.lit(NEVER)).alias("highs"))
    liked = search(some, open_, some.select("group", "block").distinct(), blocks, pages, parts, width, 1, positives, True)
    score = F.col("p.score")
    window = liked.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p")).select(  # at most ``positives``
        "row", F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: F.try_element_at("p", k)["score"]).alias("s"))
    none_low, none_high = F.lit(NEVER), F.lit(-NEVER)

    def hundredth(x: Column) -> Column:  # rounded down, in whole numbers
        return ((x - F.pmod(x, F.lit(100).cast("long"))) / F.lit(100)).cast("long")

    wanted = window.select(
        "row", F.transform("s", lambda s: F.coalesce(-hundredth(-s * low_percent), none_low)).alias("lows"),
        F.transform("s", lambda s: F.coalesce(hundredth(s * high_percent), none_high)).alias("highs"))
    hated = search(some, wanted, None, blocks, pages, parts, width, positives, negatives, False)
    pairs = liked.select("row", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hated.join(pairs, ["row", "slot"]).join(some.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def oracle_sql(positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95) -> str:
    """Brute force in DuckDB SQL for the registered query."""
    return f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
    SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN {low_percent} * positive_score AND {high_percent} * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= {negatives}"""
