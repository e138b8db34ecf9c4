"""Byte-level BPE: encoding and decoding.

Pre-tokenisation works on arrays. Every code point gets a symbol from a class
table (letter, number, white space, other) and a little lookahead; every
symbol stands for a transition function between eight states. The functions
that can arise by composing them form a small closed set, computed once with
its composition table, so a scan over a text composes them by table look-up:
first within blocks, all blocks side by side, then over the blocks, then the
states inside the blocks. A start-of-piece table over (state, symbol) gives
the boundaries. No regular expression is run.

The pieces feed pair merging with a bounded cache. Token ids and the byte
offset at which each token ends are kept; decoding is a gather of the
vocabulary's bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.llm.kernels import freed, slices, text_buffer

#: Entries of the piece cache of a Python worker; a full cache starts anew.
CACHE = 100_000
#: Text bytes encoded at once: a worker holds several arrays and lists of this many entries.
SLICE = 1 << 20
#: Pieces of more bytes are merged with a heap.
LONG = 96
BLOCK = 256
#: Rows decoded at once.
ROWS = 256

# Symbols. "Last": last white space of a run, before a character of another class.
LETTER, NUMBER, OTHER, SHORT_SUFFIX, LONG_SUFFIX, LAST_SPACE, LAST_WHITE, WHITE = range(8)
# States: what the character before belongs to.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_WHITE, ONE_MORE, TWO_MORE = range(8)

# The white space code points of Unicode.
UNICODE_WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[UNICODE_WHITE_SPACE] = WHITE
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(state after, whether the character starts a piece)."""
    if symbol == LETTER and state in (ONE_MORE, TWO_MORE):
        return (FRESH if state == ONE_MORE else ONE_MORE), False
    if symbol in (LETTER, NUMBER, OTHER, SHORT_SUFFIX, LONG_SUFFIX):
        inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHER)
        if state in (inside, AFTER_SPACE):
            return inside, False
        return {SHORT_SUFFIX: ONE_MORE, LONG_SUFFIX: TWO_MORE}.get(symbol, inside), True
    if symbol == WHITE:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if symbol == LAST_SPACE else FRESH), True


@cache
def scan_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each symbol, composition of two functions, state a function
    gives from FRESH, starts by state and symbol). Symbols 8-15 are 0-7 at the
    first character of a text: they do not depend on the state before."""
    base = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    base += [(f[FRESH],) * 8 for f in base]
    functions = list(dict.fromkeys([tuple(range(8)), *base]))
    index = {f: i for i, f in enumerate(functions)}
    for f in functions:  # grows while it is walked: the closure under composition with a symbol
        for g in base:
            h = tuple(g[x] for x in f)
            if h not in index:
                index[h] = len(functions)
                functions.append(h)
    compose = np.array([[index[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    starts = np.array([[_step(FRESH if x >= 8 else s, x % 8)[1] for x in range(16)] for s in range(8)])
    return (np.array([index[f] for f in base], np.uint16), compose,
            np.array([f[FRESH] for f in functions], np.uint8), starts)


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions where pieces start; ``points``: code points of several texts,
    ``first``: marks the first code point of each."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = class_table()[points]
    ends = np.r_[first[1:], True]  # last code point of its text
    after = np.r_[kind[1:], np.uint8(WHITE)]
    symbol = kind.copy()
    last = (kind == WHITE) & ~ends & (after != WHITE)
    symbol[last] = np.where(points[last] == 0x20, LAST_SPACE, LAST_WHITE)
    marks = np.flatnonzero((points == 0x27) & ~ends)
    if len(marks):
        one = points[marks + 1]
        room = (marks + 2 < n)
        two = points[np.minimum(marks + 2, n - 1)]
        room &= ~ends[marks + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = room & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                       | ((one == ord("l")) & (two == ord("l"))))
        symbol[marks[short]], symbol[marks[long]] = SHORT_SUFFIX, LONG_SUFFIX
    symbol[first] += 8
    of_symbol, compose, from_fresh, starts = scan_tables()
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = symbol
    grid = np.ascontiguousarray(of_symbol[padded].reshape(blocks, BLOCK).T)
    flat, width = compose.ravel(), np.uint32(compose.shape[1])
    prefix = np.empty_like(grid)  # function of the block up to and with each position
    prefix[0] = grid[0]
    for k in range(1, BLOCK):
        prefix[k] = flat[prefix[k - 1] * width + grid[k]]
    entry, state = np.empty(blocks, np.uint16), 0  # 0: the identity
    for b, whole in enumerate(prefix[-1].tolist()):
        entry[b] = state
        state = compose[state, whole]
    before = np.empty_like(grid)
    before[0] = entry
    before[1:] = flat[entry * width + prefix[:-1]]
    return np.flatnonzero(starts[from_fresh[before.T.ravel()[:n]], symbol])


class Merger:
    """Pieces (bytes) to token ids by the ranks, with a bounded cache.

    The pieces of a slice that the cache lacks are merged together: one row of
    a matrix each, one merge of every row per step, the pair with the least
    rank and of equal ones the leftmost.
    """

    NONE = np.int64(1) << 40

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.cache = ranks, {}
        self.width = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)

    def __call__(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        found = list(map(self.cache.get, pieces))
        missing = {piece for piece, ids in zip(pieces, found) if ids is None}
        if not missing:
            return found
        fresh = {}
        merge = []
        for piece in missing:
            rank = self.ranks.get(piece)
            if rank is not None:
                fresh[piece] = (rank,)
            elif len(piece) > LONG:
                fresh[piece] = tuple(self.ranks[x] for x in self.merged_long(piece))
            else:
                merge.append(piece)
        merge.sort(key=len)
        for start in range(0, len(merge), 8192):
            fresh.update(zip(merge[start:start + 8192], self.merged(merge[start:start + 8192])))
        if len(self.cache) + len(fresh) > CACHE:
            self.cache.clear()
        self.cache.update((piece, ids) for piece, ids in fresh.items() if len(piece) <= LONG)
        return [fresh[piece] if ids is None else ids for piece, ids in zip(pieces, found)]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that joins two neighbours; NONE without one, or past an end (-1)."""
        wanted = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (a >= 0) & (b >= 0), self.joined[at], self.NONE)

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        columns = np.arange(int(sizes.max()) + 1)
        ids = np.full((len(pieces), len(columns)), -1, np.int64)
        ids[columns < sizes[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        ends, open_ = [None] * len(pieces), np.arange(len(pieces))
        while len(open_):
            at = ranks.argmin(axis=1)
            rows = np.arange(len(open_))
            low = ranks[rows, at]
            done = low == self.NONE
            if done.any():
                for i, row in zip(open_[done].tolist(), ids[done].tolist()):
                    ends[i] = tuple(row[:row.index(-1)])
                keep = ~done
                open_, ids, ranks, at, low = open_[keep], ids[keep], ranks[keep], at[keep], low[keep]
                if not len(open_):
                    break
                rows = np.arange(len(open_))
            source = np.minimum(columns + (columns > at[:, None]), columns[-1])
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ids[rows, at] = low
            ranks = np.take_along_axis(ranks, source[:, :-1].clip(max=columns[-1] - 1), axis=1)
            ranks[:, -1] = self.NONE
            ranks[rows, at] = self.pair_ranks(low, ids[rows, at + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pair_ranks(ids[left, at[left] - 1], low[left])
        return ends

    def merged_long(self, piece: bytes) -> list[bytes]:
        n, get = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i; 0: merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := get(piece[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(piece[i:end[i]])
            i = end[i]
        return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: one ``base64 rank`` pair a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


_KEPT: dict[tuple[type, str], object] = {}


def _kept(kind: type, key: str, shared):
    """The worker's ``kind`` for a vocabulary; a worker keeps the last one of each kind."""
    if (kind, key) not in _KEPT:
        for old in [k for k in _KEPT if k[0] is kind]:
            del _KEPT[old]
        _KEPT[kind, key] = kind(read_ranks(shared.value))
    return _KEPT[kind, key]


class Spelling(list):
    """The bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__([b""] * (max(ranks.values()) + 1))
        for token, rank in ranks.items():
            self[rank] = token


def encode_texts(column: pa.Array, merger: Merger) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, byte offset in its text where each token ends, bounds of each text's ids)."""
    raw, offsets = text_buffer(column)
    data = raw.tobytes()
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.zeros(len(points) + 1, np.int64)
    np.cumsum(1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000), out=at[1:])
    first = np.zeros(len(points), bool)
    first[np.searchsorted(at[:-1], offsets[:-1][np.diff(offsets) > 0])] = True
    starts = at[piece_starts(points, first)]
    cuts = starts.tolist() + [len(data)]
    tokens = merger([data[a:b] for a, b in zip(cuts, cuts[1:])])
    ids = np.fromiter(chain.from_iterable(tokens), np.int32)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    bounds = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]
    return ids, offsets, bounds


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, token_ends``: the ids of every whole text, and the byte
    offsets in its UTF-8 form at which the tokens end.

    Null and empty texts give empty arrays. Rows are encoded one by one: null
    ids and repeated rows pass through, an empty table gives an empty result,
    and other columns are not read. The vocabulary is read by the driver from
    ``ranks_path`` and broadcast; its size does not depend on the data.
    """
    key, shared = _vocabulary(docs.sparkSession, ranks_path)

    def run(batches):
        merger = _kept(Merger, key, shared)
        lengths = np.zeros(max(merger.ranks.values()) + 1, np.int64)
        for token, rank in merger.ranks.items():
            lengths[rank] = len(token)
        for batch in slices(batches, "_text", SLICE):
            ids, offsets, bounds = encode_texts(batch.column(1), merger)
            ends = np.cumsum(lengths[ids]) - np.repeat(offsets[:-1], np.diff(bounds))
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "ids", "token_ends"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, ids array<int>, token_ends array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (any columns, with ``ids``) plus ``decoded``, the bytes the
    ids stand for; null ids decode to no bytes. An id outside the vocabulary
    is an error. A column named ``decoded`` is replaced."""
    key, shared = _vocabulary(encoded.sparkSession, ranks_path)
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        tokens = _kept(Spelling, key, shared)
        for whole in freed(batches):
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                column = batch.column(batch.schema.get_field_index("ids"))
                decoded = [b"".join(map(tokens.__getitem__, x or ())) for x in _id_lists(column)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                                 names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def _id_lists(column: pa.ListArray):
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for ok, a, b in zip(valid.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        yield values[a:b].tolist() if ok else None


def _vocabulary(spark: SparkSession, ranks_path: str):
    with open(ranks_path, "rb") as f:
        data = f.read()
    return hashlib.sha256(data).hexdigest(), spark.sparkContext.broadcast(data)
