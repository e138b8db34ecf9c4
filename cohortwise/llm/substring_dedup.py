"""Substring dedup: fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``BLOCK`` words,
which are indexed; every rolling window of ``BLOCK`` words of every text
probes the index. Any ``WINDOW`` words in a row hold a whole reference block,
so a repeat of that length has an anchor in the text that has it first. Hits
are extended: the windows of ``WINDOW`` words around an anchor, on both sides,
are compared in full with those of other texts; runs of confirmed windows are
the maximal repeats, and their words are removed.

Texts travel as compressed slices of about 4 MB, shuffled once by slice and
read from that shuffle three times. A slice sends to the buckets (by hash
range) only its *distinct* hashes, sorted: anchor hashes of 48 bits with a mark
for blocks, window hashes of 96 bits with the smallest id that has them here.
A bucket answers with one bit per entry, and the slice, which makes the same
sorted list again, reads off it what to do. So a window that a third of all
rows share is one entry per slice and no more, no places or owners travel, no
pairs are formed, and nothing is gathered by text. Anchor hashes only choose
what is compared; the comparison uses 96 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.kernels import U64, Words, slices, text_buffer

WINDOW = 13
#: The longest block of which every window must hold one in full.
BLOCK = (WINDOW + 1) // 2
ANCHOR_BITS = 48
_CODEC = pa.Codec("zstd", compression_level=1)
SLICE = "slice long, ids binary, size long, texts binary, ends binary"
ENTRIES = "bucket int, slice long, hashes binary, extra binary, owner binary, owners binary"
ANSWER = "slice long, bucket int, bits binary"


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes, high planes of zeros left out."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    used = 8
    while used > 1 and not planes[used - 1].any():
        used -= 1
    body = np.ascontiguousarray(planes[:used])
    return bytes([used]) + len(values).to_bytes(4, "little") + _CODEC.compress(body, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    used, n = data[0], int.from_bytes(data[1:5], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :used] = np.frombuffer(_CODEC.decompress(data[5:], n * used), np.uint8).reshape(used, n).T
    return out.reshape(-1).view("<u8")


def packed_flags(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(4, "little") + np.packbits(flags).tobytes()


def unpacked_flags(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=4), count=int.from_bytes(data[:4], "little"))


def steps(values: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[1:] -= values[:-1]
    return out


def packed_signed(values: np.ndarray) -> bytes:
    """Signed integers in any order: the least, then packed distances from it."""
    least = int(values.min()) if len(values) else 0
    return least.to_bytes(8, "little", signed=True) + packed(values.view(U64) - U64(least & (2**64 - 1)))


def unpacked_signed(data: bytes) -> np.ndarray:
    least = int.from_bytes(data[:8], "little", signed=True)
    return (unpacked(data[8:]) + U64(least & (2**64 - 1))).view(np.int64)


def _bucket(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    return ((hashes >> U64(bits - 32)) * U64(buckets)) >> U64(32)


def _cuts(sorted_buckets: np.ndarray) -> list[int]:
    if not len(sorted_buckets):
        return [0]
    return np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1], True]).tolist()


def _slice_row(number: int, ids: np.ndarray, texts: pa.Array) -> dict:
    raw, offsets = text_buffer(texts)
    return {"slice": number, "ids": packed_signed(ids), "size": len(raw), "texts": _CODEC.compress(raw, asbytes=True),
            "ends": packed(steps(offsets[1:].astype(U64)))}


def packed_slices(rows: DataFrame) -> DataFrame:
    """Rows (key_id, body) as slices: ids, compressed texts, and where each ends."""

    def pack(batches):
        n = 0
        first = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "body"):
            ids = batch.column(0).to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_pylist([_slice_row(first + n, ids, batch.column(1))])
            n += 1

    return rows.mapInArrow(pack, SLICE).repartition("slice")


class Slice:
    """A slice read back: its ids, its words, and the sorted lists it sends."""

    def __init__(self, row: dict, buckets: int):
        self.number, self.buckets = row["slice"], buckets
        self.ids = unpacked_signed(row["ids"])
        raw = _CODEC.decompress(row["texts"], row["size"]) if row["size"] else b""
        ends = np.cumsum(unpacked(row["ends"]), dtype=U64).astype(np.int64)
        offsets = pa.py_buffer(np.concatenate([np.zeros(1, np.int64), ends]))
        texts = pa.Array.from_buffers(pa.large_string(), len(ends), [None, offsets, pa.py_buffer(raw)])
        self.words = Words(texts)
        self.owner = np.repeat(np.arange(len(self.ids)), self.words.count)

    def anchors(self):
        """(sorted distinct anchor hashes, block marks, start of each bucket,
        entry of each valid window, places of these windows)."""
        hashes, valid = self.words.windows(BLOCK)
        at = np.flatnonzero(valid)
        block = (at - self.words.first[self.owner[at]]) % BLOCK == 0
        values, entry = np.unique(hashes[at] >> U64(64 - ANCHOR_BITS), return_inverse=True)
        mark = np.zeros(len(values), bool)
        mark[entry[block]] = True
        return values, mark, _cuts(_bucket(values, ANCHOR_BITS, self.buckets)), entry, at

    def wanted(self, answers) -> np.ndarray:
        """Places of windows around anchors, after the buckets' ``answers``
        (bucket, bits): a hash that another slice has too, or that texts of
        different ids share here, with a block on some side."""
        values, mark, cuts, entry, at = self.anchors()
        hit = _answered(values, ANCHOR_BITS, self.buckets, cuts, answers)
        ids = self.ids[self.owner[at]]
        least, most = np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), np.iinfo(np.int64).min)
        np.minimum.at(least, entry, ids)
        np.maximum.at(most, entry, ids)
        hit |= mark & (least < most)
        spot = at[hit[entry]]
        # windows that hold an anchor: start up to WINDOW - BLOCK words before it, in the same text
        near = np.zeros(len(self.words.start) + 1, np.int64)
        np.add.at(near, np.maximum(spot - (WINDOW - BLOCK), self.words.first[self.owner[spot]]), 1)
        np.add.at(near, spot + 1, -1)
        return np.flatnonzero((np.cumsum(near[:-1]) > 0) & self.words.windows(WINDOW, 1)[1])

    def windows(self, answers):
        """(hash, extra, least id) of the distinct windows around anchors in
        order, start of each bucket, entry of each such window, their places."""
        at = self.wanted(answers)
        first, second = self.words.windows(WINDOW, 1)[0][at], self.words.windows(WINDOW, 2)[0][at] >> U64(32)
        order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])] if len(order) else np.zeros(0, bool)
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        first, second = first[new], second[new]
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, entry, self.ids[self.owner[at]])
        return first, second, least, _cuts(_bucket(first, 64, self.buckets)), entry, at

    def repeated(self, answers, again) -> np.ndarray:
        """Places of windows that also start in a text with a smaller id;
        ``again``: the buckets' second answers, a smaller id in another slice."""
        first, _, least, cuts, entry, at = self.windows(answers)
        elsewhere = _answered(first, 64, self.buckets, cuts, again)
        return at[elsewhere[entry] | (self.ids[self.owner[at]] > least[entry])]


def _answered(values: np.ndarray, bits: int, buckets: int, cuts: list[int], answers) -> np.ndarray:
    """The answered bits of a sorted list, false where a bucket had nothing to say."""
    out = np.zeros(len(values), bool)
    of = dict(zip((int(b) for b in _bucket(values[cuts[:-1]], bits, buckets)), zip(cuts[:-1], cuts[1:]))) if len(values) else {}
    for a in answers or []:
        start, stop = of[a["bucket"]]
        out[start:stop] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=stop - start).astype(bool)
    return out


def _read(batches, buckets: int):
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
            yield Slice(row, buckets), row


def _sent(number: int, buckets: np.ndarray, cuts: list[int], columns) -> pa.RecordBatch:
    """One row per bucket; ``columns``: a function of (start, stop) to the packed columns."""
    rows = [columns(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets.astype(np.int32)), pa.array(np.full(len(rows), number, np.int64)),
         *[pa.array([r[k] for r in rows], pa.binary()) for k in range(4)]],
        names=["bucket", "slice", "hashes", "extra", "owner", "owners"])


def _answers(sent: DataFrame, judge) -> DataFrame:
    """Per slice the list of (bucket, bits) with some bit set."""

    def match(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bits = judge(rows)
        some = [i for i, b in enumerate(bits) if b.any()]
        return pa.table({"slice": pa.array([rows[i]["slice"] for i in some], pa.int64()),
                         "bucket": pa.array([rows[i]["bucket"] for i in some], pa.int32()),
                         "bits": pa.array([np.packbits(bits[i]).tobytes() for i in some], pa.binary())})

    given = sent.groupBy("bucket").applyInArrow(match, ANSWER)
    return given.groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("bits"))  # at most one per bucket


def _split(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(sizes)[:-1])


def anchor_answers(held: DataFrame, buckets: int) -> DataFrame:
    """Anchor hashes of each slice that another slice has too, a block on some side."""

    def emit(batches):
        for part, _ in _read(batches, buckets):
            values, mark, cuts, _, _ = part.anchors()
            yield _sent(part.number, _bucket(values[cuts[:-1]], ANCHOR_BITS, buckets) if len(values) else values, cuts, lambda a, b: (
                packed(steps(values[a:b])), packed_flags(mark[a:b]), None, None))

    def judge(rows):
        lists = [np.cumsum(unpacked(r["hashes"]), dtype=U64) for r in rows]
        every = np.concatenate(lists)
        mark = np.concatenate([unpacked_flags(r["extra"]) for r in rows]).astype(bool)
        order = np.argsort(every, kind="stable")
        ordered, mark = every[order], mark[order]
        start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        count = np.diff(np.r_[start, len(ordered)])
        hit = (count > 1) & np.logical_or.reduceat(mark, start)  # a slice sends a hash once
        out = np.empty(len(every), bool)
        out[order] = np.repeat(hit, count)
        return _split(out, [len(x) for x in lists])

    return _answers(held.mapInArrow(emit, ENTRIES), judge)


def window_answers(held: DataFrame, buckets: int) -> DataFrame:
    """Windows of each slice that another slice has with a smaller id. ``held``: slices with their anchor answers."""

    def emit(batches):
        for part, row in _read(batches, buckets):
            if not row["bits"] and len(np.unique(part.ids)) < 2:
                continue
            first, second, least, cuts, _, _ = part.windows(row["bits"])

            def columns(a, b):
                owners, owner = np.unique(least[a:b], return_inverse=True)
                return packed(steps(first[a:b])), packed(second[a:b]), packed(owner), packed_signed(owners)

            yield _sent(part.number, _bucket(first[cuts[:-1]], 64, buckets) if len(first) else first, cuts, columns)

    def judge(rows):
        lists = [np.cumsum(unpacked(r["hashes"]), dtype=U64) for r in rows]
        hashes, extra = np.concatenate(lists), np.concatenate([unpacked(r["extra"]) for r in rows])
        ids = np.concatenate([unpacked_signed(r["owners"])[unpacked(r["owner"]).astype(np.int64)] for r in rows])
        order = np.lexsort((ids, extra, hashes))
        h, x, i = hashes[order], extra[order], ids[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (x[1:] != x[:-1])]
        least = i[np.flatnonzero(new)[np.cumsum(new) - 1]]
        out = np.empty(len(hashes), bool)
        out[order] = i > least
        return _split(out, [len(y) for y in lists])

    return _answers(held.mapInArrow(emit, ENTRIES), judge)


def _kept(part: Slice, places: np.ndarray) -> pa.RecordBatch:
    """The words that no repeated window covers."""
    words = part.words
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + WINDOW, -1)
    keep = np.cumsum(cover[:-1]) == 0
    count = np.concatenate([[0], np.cumsum(keep)])
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    ends = np.cumsum(size)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    raw = np.append(words.raw, np.uint8(32))
    out = raw[source] if len(source) else raw[:0].copy()
    out[ends - 1] = 32
    bounds = np.concatenate([[0], ends])[count[words.first]]
    text = out.tobytes()
    kept = [text[a:max(b - 1, a)] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
    left = np.diff(count[words.first])
    return pa.RecordBatch.from_arrays(
        [pa.array(part.ids), pa.array(words.count, pa.int64()), pa.array(words.count - left, pa.int64()),
         pa.array(kept, pa.binary()).view(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


OUTPUT = "doc_id long, n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row: the words that
    no window repeated from a smaller id covers, joined by one space.

    Null, empty and blank texts have no words. Rows with a null id are neither
    a reference nor cut. Rows that repeat an id are one reference: windows
    they share are not repeats of each other. Texts of any length are handled
    whole. An empty table gives an empty result; other columns are not read.
    """
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("key_id"), F.col(text_col).alias("body"))
    held = packed_slices(rows.where("key_id IS NOT NULL"))
    first = anchor_answers(held, buckets)
    # one plan for the slices in all places, so that Spark shuffles them once
    asked = held.join(first.hint("shuffle_hash"), "slice", "left")
    second = window_answers(asked, buckets).withColumnRenamed("bits", "again")

    def cut(batches):
        for part, row in _read(batches, buckets):
            yield _kept(part, part.repeated(row["bits"], row["again"]))

    named = asked.join(second.hint("shuffle_hash"), "slice", "left").mapInArrow(cut, OUTPUT)

    def uncut(batches):
        for batch in slices(batches, "body"):
            part = Slice(_slice_row(0, np.zeros(batch.num_rows, np.int64), batch.column(1)), 1)
            done = _kept(part, np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[done.column(k) for k in range(1, 4)]], names=done.schema.names)

    return named.unionByName(rows.where("key_id IS NULL").mapInArrow(uncut, OUTPUT))
