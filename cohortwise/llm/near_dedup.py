"""Near dedup: set similarity join by chosen paths over minwise tokens.

Texts are sets of word shingles. Each set is reduced to ``TOKENS`` minwise
tokens. In each of ``TREES`` independent trees a text goes to the child nodes
named by a few *selected* tokens (a token is selected if its hash in that tree
is small, so texts that share it select it together). Nodes with at most
``LEAF`` texts are compared exhaustively by their tokens; larger ones are
compared in random blocks and branched again on fresh tokens, for as long as
they hold texts not known to be connected. Branching parts texts that share
little; a large node of near copies has children as large as itself. So a node
whose texts share a third of their tokens, or are one part but for ``LEAF``
texts, is compared whole: block against block, without the pairs inside its
largest part. So is a node that still is large and mixed after ``DEPTH``
levels; no size is a limit. Every link is confirmed on the full shingle sets.

Recall: a pair at the similarity threshold shares a selected token in one tree
with probability 1 - exp(-BRANCH * 0.75) = 0.85, in one of ``TREES`` with more
than 0.9999. Nodes beyond ``LEAF`` branch by ``DEEPER``: such a pair shares
``DEEPER * 0.75`` = 2.25 children of each on average, well over one, so the
nodes it shares do not die out from level to level. A pair whose shared nodes
all stay large is lost with probability exp(-TREES * BRANCH * 0.75 * 0.85),
under 1e-4, however deep. The price is up to ``DEEPER`` times the rows on each
level of a dense node.

Only connectivity is wanted, and pairs never leave a task: first the best
spanning forest of every node is confirmed; then, in nodes that the forests
left in parts, the texts that may be linked across parts meet again with their
full sets, and the task that has them returns confirmed links alone. A pair is
checked in the first of the nodes it shares that are compared as a whole, on
whatever level. Equal sets are merged to one representative beforehand.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.components import connected
from cohortwise.llm.kernels import U64, Words, freed, mix, per_text_unique, slices, text_buffer
from cohortwise.llm.storage import written

SHINGLE = 5
#: Text bytes made into signatures at once: a worker holds several arrays of eight times this size, and keeps some when idle.
SLICE = 1 << 20
TOKENS, TREES, BRANCH, DEEPER = 128, 6, 2.5, 3.0
LEAF, DEPTH = 4096, 4
#: Texts of a large node that tell how alike its texts are (about so many, by hash).
SAMPLE = 64
#: Bytes that the sets of a leaf may take, a byte for each bit while they are made.
BITS = 1 << 26
#: Share of equal tokens from which a pair is confirmed; 0.75 lies four standard deviations above.
ESTIMATE = 0.60
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75

_MULTIPLIERS = mix(np.arange(1, TOKENS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_POSITION = mix(np.arange(TOKENS, dtype=U64) + U64(77))
_TREE = mix(np.arange(TREES, dtype=U64) + U64(7700))
_SELECT, _SELECT_DEEPER = (U64(int(x / TOKENS * 2.0**64)) for x in (BRANCH, DEEPER))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and bounds."""
    words = Words(column, lower=True)
    hashes, valid = words.windows(SHINGLE)
    count = words.count
    docs = np.repeat(np.arange(len(count)), count)
    short = (count > 0) & (count < SHINGLE)
    for size in range(1, SHINGLE):  # the whole sequence as one shingle
        which = np.flatnonzero(short & (count == size))
        if len(which):
            own, _ = words.windows(size)
            at = words.first[which]
            hashes[at], valid[at] = own[at], True
    keep = np.flatnonzero(valid)
    bounds = np.searchsorted(docs[keep], np.arange(len(count) + 1))
    return per_text_unique(hashes[keep], bounds)


def _signatures(batches):
    for batch in slices(batches, "_text", SLICE):
        values, bounds = shingle_sets(batch.column(1))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        minima = np.empty((len(full), TOKENS), U64)
        for i in range(TOKENS if len(full) else 0):
            scrambled = values * _MULTIPLIERS[i]
            scrambled ^= scrambled >> U64(32)
            minima[:, i] = np.minimum.reduceat(scrambled, bounds[:-1][full])
        names = mix(minima + _POSITION)
        paths = [[] for _ in range(batch.num_rows)]
        for tree in range(TREES):
            picked = mix(names ^ _TREE[tree])
            for row, token in zip(*(x.tolist() for x in np.nonzero(picked < _SELECT))):
                paths[full[row]].append(int(mix(picked[row, token:token + 1] + U64(tree))[0]) - (1 << 63))
        short = (minima & U64(0xFFFF)).astype(np.uint16)
        tokens, sets = [b""] * batch.num_rows, [b""] * batch.num_rows
        for row, i in enumerate(full.tolist()):
            tokens[i] = short[row].tobytes()
            sets[i] = hashlib.blake2b(values[bounds[i]:bounds[i + 1]].tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
            pa.array(tokens, pa.binary()), pa.array(paths, pa.list_(pa.int64()))],
            names=["_id", "n_shingles", "set_id", "tokens", "paths"])


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal tokens of every row of ``a`` with every row of ``b``."""
    out = np.zeros((len(a), len(b)), np.uint8)
    columns = np.ascontiguousarray(b.T)
    for start in range(0, len(a), 64):
        for k in range(TOKENS):
            out[start:start + 64] += a[start:start + 64, k, None] == columns[k]
    return out


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` share tokens enough to be links. Rows with
    that many equal tokens differ in few of the tokens' lowest bits: most
    others go by these bits, the rest by all tokens."""
    need = int(np.ceil(ESTIMATE * TOKENS))
    if len(a) * len(b) <= 2048:
        return np.count_nonzero(a[:, None, :] == b[None, :, :], axis=2) >= need
    low_a, low_b = (np.packbits((x & 1).astype(bool), axis=1).view(U64) for x in (a, b))
    out = np.zeros((len(a), len(b)), bool)
    for start in range(0, len(a), 64):
        part = slice(start, start + 64)
        differ = np.zeros((len(low_a[part]), len(b)), np.uint8)
        for k in range(low_a.shape[1]):
            differ += np.bitwise_count(low_a[part, k, None] ^ low_b[:, k])
        i, j = np.nonzero(differ <= TOKENS - need)
        if len(i) * 8 > differ.size:
            out[part] = _equal(a[part], b) >= need
        else:
            out[start + i, j] = np.count_nonzero(a[start + i] == b[j], axis=1) >= need
    return out


def _forest(tokens: np.ndarray):
    """Edges of the best spanning forest over pairs that may be links."""
    near = _near(tokens, tokens)
    np.fill_diagonal(near, False)
    rows = np.flatnonzero(near.any(axis=1))
    n = len(rows)
    share = _equal(tokens[rows], tokens[rows]) / np.float32(TOKENS)
    best, parent, open_ = np.full(n, -1.0, np.float32), np.zeros(n, np.int64), np.ones(n, bool)
    for _ in range(n):
        i = int(np.argmax(np.where(open_, best, -2.0)))
        if best[i] >= ESTIMATE:
            yield int(rows[parent[i]]), int(rows[i])
        open_[i] = False
        closer = open_ & (share[i] > best)
        best[closer], parent[closer] = share[i][closer], i


def _by_leaf(batches):
    """Tables of whole leaves from batches sorted by leaf."""
    left = None
    for batch in freed(batches):
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
        leaf = table["leaf"].to_numpy()
        done = int(np.searchsorted(leaf, leaf[-1], "left"))  # the last leaf may go on
        left = table.slice(done).combine_chunks()
        if done:
            yield table.slice(0, done)
    if left is not None:
        yield left


def _cuts(table: pa.Table) -> list[int]:
    leaf = table["leaf"].to_numpy()
    return np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1], True]).tolist()


def _tokens(table: pa.Table) -> np.ndarray:
    return text_like(table["tokens"])[0].view(np.uint16).reshape(-1, TOKENS)


def _forests(batches):
    """Pairs of the best spanning forest of each leaf; rows (leaf, rep, tokens)."""
    for table in _by_leaf(batches):
        reps, tokens, cuts = table["rep"].to_numpy(), _tokens(table), np.array(_cuts(table))
        two = cuts[:-1][np.diff(cuts) == 2]
        two = two[(tokens[two] == tokens[two + 1]).mean(axis=1) >= ESTIMATE]
        a, b = [reps[two]], [reps[two + 1]]
        for c, d in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if d - c > 2:
                found = list(_forest(tokens[c:d]))
                if found:
                    i, j = np.array(found).T
                    a.append(reps[c + i]), b.append(reps[c + j])
        a, b = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _bits(values: np.ndarray, bounds: np.ndarray) -> np.ndarray | None:
    """The sets ``values[bounds[i]:bounds[i+1]]`` as rows of bits, one bit for
    each value that several of them hold; None if that takes over ``BITS`` bytes."""
    n = len(bounds) - 1
    order = np.argsort(values, kind="stable")
    value = values[order]
    head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, int)
    times = np.diff(np.r_[head, len(value)])
    width = -(-int((times > 1).sum()) // 64) * 64
    if n * width > BITS:
        return None
    out = np.zeros((n, max(width, 64)), bool)
    column = np.repeat(np.cumsum(times > 1) - 1, times)
    several = np.repeat(times > 1, times)
    out[np.repeat(np.arange(n), np.diff(bounds))[order][several], column[several]] = True
    return np.packbits(out, axis=1).view(U64)


def _open_pairs(tokens, comps, blocks, earlier) -> np.ndarray:
    """Upper triangle of pairs that may be links, are not known to be connected,
    and meet in no earlier leaf. Of two blocks, only pairs across them."""
    n = len(tokens)
    near = np.zeros((n, n), bool)
    if (blocks != blocks[0]).any():
        a, b = np.flatnonzero(blocks == blocks[0]), np.flatnonzero(blocks != blocks[0])
    elif n <= 32:
        a = b = np.arange(n)
    else:  # those of the largest part are connected
        _, part, size = np.unique(comps, return_inverse=True, return_counts=True)
        a, b = np.flatnonzero(part != np.argmax(size)), np.arange(n)
    found = _near(tokens[a], tokens[b]) & (comps[a][:, None] != comps[b][None, :])
    i, j = np.nonzero(found)
    near[np.minimum(a[i], b[j]), np.maximum(a[i], b[j])] = True
    seen, bounds = earlier
    if len(i) and len(seen):
        met = _bits(seen, bounds)
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            others = np.flatnonzero(near[i])
            if met is not None:
                before = (met[others] & met[i]).any(axis=1)
            else:
                own = seen[bounds[i]:bounds[i + 1]]
                before = np.array([np.isin(own, seen[bounds[j]:bounds[j + 1]]).any() for j in others.tolist()])
            near[i, others[before]] = False
    return near


def _leaf_pairs(table: pa.Table):
    """(first row, end, open pairs) of the leaves of rows (leaf, rep, comp, block, earlier, tokens)."""
    comps, blocks, tokens = table["comp"].to_numpy(), table["block"].to_numpy(), _tokens(table)
    lists = table["earlier"].combine_chunks()
    bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    seen = lists.flatten().to_numpy()
    for c, d in zip(cuts := _cuts(table), cuts[1:]):
        if d - c > 1:
            own = seen[bounds[c]:bounds[d]], bounds[c:d + 1] - bounds[c]
            yield c, d, _open_pairs(tokens[c:d], comps[c:d], blocks[c:d], own)


def _with_open_pairs(batches):
    """The rows (leaf, rep, comp, block, earlier, tokens) of texts with such a pair."""
    for table in _by_leaf(batches):
        keep = [c + np.flatnonzero(near.any(axis=0) | near.any(axis=1)) for c, _, near in _leaf_pairs(table)]
        yield from table.take(np.concatenate(keep) if keep else np.zeros(0, int)).to_batches()


def _in_both(i: int, others: np.ndarray, values, bounds, bits) -> np.ndarray:
    """How many values the set ``i`` shares with each of the others."""
    if bits is not None:
        return np.bitwise_count(bits[others] & bits[i]).sum(axis=1, dtype=np.int64)
    own = values[bounds[i]:bounds[i + 1]]
    all_of = np.concatenate([values[bounds[j]:bounds[j + 1]] for j in others.tolist()])
    found = own[np.minimum(np.searchsorted(own, all_of), len(own) - 1)] == all_of
    starts = np.concatenate([[0], np.cumsum(np.diff(bounds)[others])[:-1]])
    return np.add.reduceat(found, starts, dtype=np.int64)


def _sets(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of a column, a slice of it at a time."""
    parts = [shingle_sets(x.column(0)) for x in slices(pa.table({"text": texts}).to_batches(), "text", SLICE)]
    return (np.concatenate([values for values, _ in parts]),
            np.concatenate([[0], np.cumsum(np.concatenate([np.diff(bounds) for _, bounds in parts]))]))


def _exact_links(batches):
    """Confirmed links across parts; rows (leaf, rep, comp, block, earlier, tokens, text)."""
    for table in _by_leaf(batches):
        reps, comps = table["rep"].to_numpy(), table["comp"].to_numpy()
        links = []
        for c, d, near in _leaf_pairs(table):
            values, bounds = _sets(table["text"].slice(c, d - c))
            sizes, part, bits = np.diff(bounds), comps[c:d].copy(), _bits(values, bounds)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                others = np.flatnonzero(near[i] & (part != part[i]))
                if not len(others):
                    continue
                both = _in_both(i, others, values, bounds, bits)
                for j in others[100 * both >= PERCENT * (sizes[i] + sizes[others] - both)].tolist():
                    if part[i] != part[j]:
                        links.append((reps[c + i], reps[c + j]))
                        part[part == part[j]] = part[i]
        if links:
            a, b = np.array(links).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _shares(batches):
    """Mean share of equal tokens of the pairs of each leaf; rows (leaf, tokens)."""
    for table in _by_leaf(batches):
        leaf, tokens, cuts = table["leaf"].to_numpy(), _tokens(table), _cuts(table)
        shares = [float((_equal(tokens[c:d], tokens[c:d]).sum() / TOKENS - (d - c)) / max((d - c) * (d - c - 1), 1))
                  for c, d in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(leaf[cuts[:-1]]), pa.array(shares, pa.float64())], names=["node", "share"])


def text_like(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets


def _leaves(rows: DataFrame) -> DataFrame:
    return rows.repartition("leaf").sortWithinPartitions("leaf")


def _pieces(rows: DataFrame) -> DataFrame:
    """Large nodes, all of them: every block of the texts outside the node's
    largest part against each block of it and of themselves; rows (node, rep,
    comp, n, top, most, tokens) as (leaf, node, rep, comp, block, tokens)."""
    inner, outer = (F.ceil(x / F.lit(LEAF // 2)).cast("long") for x in (F.col("most"), F.col("n") - F.col("most")))
    own = F.when(F.col("comp") == F.col("top"), F.pmod(F.xxhash64("rep"), inner)).otherwise(
        inner + F.pmod(F.xxhash64("rep"), outer))
    first = F.when(F.col("comp") == F.col("top"), inner).otherwise(F.lit(0).cast("long"))
    cut = rows.withColumn("block", own).withColumn("_o", F.explode(F.sequence(first, inner + outer - 1)))
    return cut.select(F.xxhash64("node", F.least("block", "_o"), F.greatest("block", "_o")).alias("leaf"),
                      "node", "rep", "comp", "block", "tokens")


def _judged(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rows (node, rep, comp, n) of large nodes with their ``tokens``, the largest
    part of the node ``top``, its size ``most``, and ``whole``: not to be branched,
    as few texts are outside that part, or as so many tokens are equal that the
    children of a text would hold, all together, no fewer texts than the node."""
    tops = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("node").agg(
        F.max(F.struct("k", "comp")).alias("x")).select("node", F.col("x.comp").alias("top"), F.col("x.k").alias("most"))
    some = rows.where(F.pmod(F.xxhash64("rep", "node"), F.col("n")) < SAMPLE)
    shares = _leaves(some.join(tokens, "rep").select(F.col("node").alias("leaf"), "tokens")).mapInArrow(
        _shares, "node long, share double")
    whole = (F.col("n") - F.col("most") <= LEAF) | (F.coalesce("share", F.lit(0.0)) * DEEPER >= 1)
    return rows.join(tops.join(shares, "node", "left"), "node").join(tokens, "rep").select(
        "node", "rep", "comp", "n", "top", "most", whole.alias("whole"), "tokens")


def _confirm(batches):
    def shingles(text):
        words = text.translate(_ASCII_LOWER).split(" ")
        words = [w for w in words if w]
        return set(zip(*(words[k:] for k in range(SHINGLE)))) if len(words) >= SHINGLE else {tuple(words)}

    for batch in freed(batches):
        keep, last, own = [], None, None
        for i, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            if a != last:
                last, own = a, shingles(a or "")
            other = shingles(b or "")
            both = len(own & other)
            if 100 * both >= PERCENT * (len(own) + len(other) - both):
                keep.append(i)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


#: A-Z to lower case, the six white-space characters to a space.
_ASCII_LOWER = {**{c: c + 32 for c in range(65, 91)}, **{c: 32 for c in range(9, 14)}}


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough; texts: (id, text)."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(_confirm, "a long, b long").distinct()


def _branched(batches):
    """Children of rows (node, rep, comp, tokens) on fresh tokens."""
    for batch in freed(batches):
        if not batch.num_rows:
            continue
        node = batch.column(0).to_numpy().astype(np.int64).view(U64)
        raw, _ = text_like(batch.column(3))
        tokens = raw.view(np.uint16).reshape(-1, TOKENS)
        for start in range(0, len(node), 4096):
            part = mix((tokens[start:start + 4096].astype(U64) + _POSITION) ^ mix(node[start:start + 4096])[:, None])
            row, token = np.nonzero(part < _SELECT_DEEPER)
            child = mix(part[row, token] + U64(1)).view(np.int64)
            at = pa.array(row + start)
            yield pa.RecordBatch.from_arrays(
                [pa.array(child), batch.column(1).take(at), batch.column(2).take(at)], names=["node", "rep", "comp"])


def _sized(rows: DataFrame) -> DataFrame:
    """Rows (node, rep, comp) of nodes that hold unconnected texts, with the size ``n`` of their node."""
    stats = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
    return rows.join(stats.where("_lo < _hi").select("node", "n"), "node")


def _leaf(n, limit: int) -> F.Column:
    """Small nodes as they are, large ones in random blocks."""
    return F.when(n <= limit, F.col("node")).otherwise(
        F.xxhash64("node", F.pmod(F.xxhash64("rep", "node"), F.ceil(n / F.lit(limit)))))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Null, empty and blank texts have no shingles, are linked with nothing and
    stay. A row with a null id is linked with nothing; its component is null
    and it stays. Rows that repeat an id count as one text group (they share
    their component). Ties do not arise: the smallest id of a component stays.
    Texts of any length are compared whole; an empty table gives an empty
    result; no other column is read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    signed = written(source.mapInArrow(
        _signatures, "_id long, n_shingles long, set_id binary, tokens binary, paths array<long>"), "signatures")
    usable = signed.where("n_shingles > 0 AND _id IS NOT NULL")
    reps = written(usable.groupBy("set_id").agg(
        F.min("_id").alias("rep"), F.min_by(F.struct("tokens", "paths"), "_id").alias("x"))
        .select("set_id", "rep", "x.tokens", "x.paths"), "representatives")

    rows = reps.select(F.explode("paths").alias("node"), "rep", F.col("rep").alias("comp")).dropDuplicates(["node", "rep"])
    nodes = written(_sized(rows), "nodes")

    def texts_of(ids):
        return written(source.select(F.col("_id").alias("id"), F.col("_text").alias("text")).join(ids, "id", "left_semi"), "texts")

    # round 1: the forests of all nodes
    whole = nodes.withColumn("leaf", _leaf(F.col("n"), LEAF)).join(reps.select("rep", "tokens"), "rep")
    forest = written(_leaves(whole.select("leaf", "rep", "tokens")).mapInArrow(_forests, "a long, b long")
                     .where("a < b").distinct(), "forest")
    ids = forest.select(F.col("a").alias("id")).union(forest.select("b")).distinct()
    texts = texts_of(ids)  # of every text with a near one in some node
    links = written(_links(forest, texts), "links")
    known = connected(links)

    # round 2: what the forests left apart
    parts = nodes.select("node", "rep").join(known, F.col("rep") == F.col("id"), "left").select(
        "node", "rep", F.coalesce("comp", "rep").alias("comp"))
    level, found, met = written(_sized(parts), "mixed"), [], []
    for depth in range(DEPTH + 1):
        tokens = reps.select("rep", "tokens")
        small, large = level.where(F.col("n") <= LEAF), level.where(F.col("n") > LEAF)
        some = not large.isEmpty()
        leaves = small.join(tokens, "rep").select(
            F.col("node").alias("leaf"), "node", "rep", "comp", F.lit(0).cast("long").alias("block"), "tokens")
        here = small.select("node", "rep")
        if some:
            large = written(_judged(large, tokens), "large")
            whole, rest = (large.where("whole"), large.where("NOT whole")) if depth < DEPTH else (large, large.where("false"))
            leaves, here = leaves.unionByName(_pieces(whole)), here.unionByName(whole.select("node", "rep"))
            if depth:  # some pairs of nodes to be branched again, now
                leaves = leaves.unionByName(rest.select(
                    _leaf(F.col("n"), LEAF).alias("leaf"), "node", "rep", "comp", F.lit(-1).cast("long").alias("block"), "tokens"))
        met.append(here.withColumn("depth", F.lit(depth)))
        of_text = met[0]
        for x in met[1:]:
            of_text = of_text.unionByName(x)
        of_text = of_text.groupBy("rep").agg(F.collect_list(F.struct("depth", "node")).alias("met"))  # at most the nodes of a text
        earlier = F.transform(F.filter("met", lambda x: (x["depth"] < depth) | (x["node"] < F.col("node")) | (F.col("block") < 0)),
                              lambda x: x["node"])
        columns = ["leaf", "rep", "comp", "block", "earlier", "tokens"]
        leaves = leaves.join(of_text, "rep", "left").withColumn(
            "earlier", F.coalesce(earlier, F.array().cast("array<long>"))).select(columns)
        found.append(written(_leaves(leaves).mapInArrow(
            _with_open_pairs, "leaf long, rep long, comp long, block long, earlier array<long>, tokens binary"), "open"))
        if not some or rest.isEmpty():
            break
        children = rest.select("node", "rep", "comp", "tokens").mapInArrow(
            _branched, "node long, rep long, comp long").dropDuplicates(["node", "rep"])
        level = written(_sized(children), "children")
    meet = found[0]
    for x in found[1:]:
        meet = meet.unionByName(x)
    wanted = meet.select(F.col("rep").alias("id")).distinct()
    if len(found) > 1 or some:  # blocks of the first round may have kept near ones apart
        missing = written(wanted.join(texts, "id", "left_anti"), "missing")
        texts = texts if missing.isEmpty() else texts.union(texts_of(missing))
    meet = meet.join(texts, F.col("rep") == F.col("id")).drop("id")
    more = written(_leaves(meet).mapInArrow(_exact_links, "a long, b long").distinct(), "links")
    if not more.isEmpty():
        known = connected(links.union(more))

    labels = reps.select("set_id", "rep").join(known, F.col("rep") == known["id"], "left").select(
        "set_id", F.coalesce("comp", "rep").alias("component_id"))
    out = signed.select("_id", "n_shingles", "set_id").join(labels, "set_id", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("_id").isNotNull(), F.col("component_id")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias("doc_id"), "n_shingles", component.alias("component_id"),
                      F.col("_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one id of each component, with all their columns."""
    gone = classes(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
