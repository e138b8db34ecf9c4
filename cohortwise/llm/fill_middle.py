"""Fill-in-middle transformation over content-defined chunks.

A text is cut in two places between its lines; prefix, middle and suffix are
written out in a new order with sentinels. Where the cuts lie is found without
splitting the text into lines: a rolling hash over ``SPAN`` bytes divides it
into content-defined chunks, so passages that texts share give the same chunks
wherever they stand. Each chunk's summary (line ends, their places, code
points) is memoised; the key of the cache is the chunk itself, so a hit has
been verified by content. Adding up the summaries of a text's chunks gives its
number of lines and code points, and the chunk that holds a cut; the place
within it comes from that chunk's summary.

Runs per text inside tasks, without any shuffle. The cache of a task holds at
most ``CACHE_BYTES`` of chunks and starts afresh when full; a long text is
hashed and looked up piece by piece.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.kernels import U64, mix, slices, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PERCENT, SPM_PERCENT = 7, 100, 50
#: Bytes the rolling hash covers, and the least length of a chunk.
SPAN = 32
#: A chunk ends where these bits of the rolling hash are zero: every 1,024 bytes or so.
MASK = np.uint32(0xFFC00000)
#: Bytes hashed at once, and the most that a chunk can hold.
PIECE = 1 << 20
CACHE_BYTES = 64 << 20
#: One 32-bit number per byte value, from the shared mixer.
_GEAR = (mix(np.arange(1, 257, dtype=U64)) >> U64(32)).astype(np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """Gear hash of the ``SPAN`` bytes that end at each byte: sums of shifted
    byte numbers, built by doubling the span."""
    h, width = _GEAR[raw], 1
    while width < SPAN:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def chunk_ends(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of one piece of a text."""
    ends, last = [], 0
    for at in (np.flatnonzero((rolling(raw) & MASK) == 0) + 1).tolist():
        if at - last >= SPAN:
            ends.append(at)
            last = at
    if last < len(raw):
        ends.append(len(raw))
    return ends


class Summaries:
    """Chunk -> (line ends in it, code points, places behind its line ends)."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.held, self.hits, self.misses = limit, 0, 0, 0
        self._of: dict[bytes, tuple[int, int, np.ndarray]] = {}

    def __call__(self, chunk: bytes) -> tuple[int, int, np.ndarray]:
        found = self._of.get(chunk)  # equal hashes are compared byte by byte
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        raw = np.frombuffer(chunk, np.uint8)
        lines = (np.flatnonzero(raw == 10) + 1).astype(np.int32)
        found = (len(lines), int(np.count_nonzero((raw & 0xC0) != 0x80)), lines)
        size = len(chunk) + 4 * len(lines)
        if self.held + size > self.limit:
            self._of.clear()
            self.held = 0
        if size <= self.limit:
            self._of[chunk] = found
            self.held += size
        return found


class Text:
    """A text as the running sums of its chunks' summaries."""

    def __init__(self, raw: np.ndarray, data: bytes, summaries: Summaries):
        self.data, self._of = data, summaries
        self.ends: list[int] = []
        for start in range(0, len(raw), PIECE):
            self.ends += [start + e for e in chunk_ends(raw[start:start + PIECE])]
        starts = [0, *self.ends[:-1]]
        found = [summaries(data[a:b]) for a, b in zip(starts, self.ends)]
        self.lines = list(accumulate((f[0] for f in found), initial=0))
        self.points = list(accumulate((f[1] for f in found), initial=0))
        self.places = [f[2] for f in found]
        self.starts = starts
        closed = not data or data[-1] == 10
        self.units = self.lines[-1] + (not closed)

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``units`` lines."""
        if units >= self.units:
            return len(self.data), self.points[-1]
        if units == 0:
            return 0, 0
        chunk = bisect_left(self.lines, units) - 1  # the one that holds this line's end
        start, inside = self.starts[chunk], int(self.places[chunk][units - self.lines[chunk] - 1])
        part = np.frombuffer(self.data, np.uint8, inside, start)
        return start + inside, self.points[chunk] + int(np.count_nonzero((part & 0xC0) != 0x80))


def _cuts(batches, percent: int, spm_percent: int, sentinels: tuple[bytes, bytes, bytes]):
    """Rows (doc_id, text, h1 .. h4) to the transformed texts."""
    summaries = Summaries()
    first, second, third = sentinels
    for batch in slices(batches, "_text"):
        raw, offsets = text_buffer(batch.column(1))
        draws = [batch.column(k).to_pylist() for k in range(2, 6)]
        n, form, prefix_chars, middle_chars, out = [], [], [], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            data = raw[a:b].tobytes()
            text = Text(raw[a:b], data, summaries)
            h1, h2, h3, h4 = (d[i] for d in draws)
            n.append(text.units)
            if not data or h3 % 100 >= percent or any(s in data for s in sentinels):
                form.append("plain"), prefix_chars.append(None), middle_chars.append(None), out.append(data)
                continue
            low, high = sorted((h1 % (text.units + 1), h2 % (text.units + 1)))
            (x, x_chars), (y, y_chars) = text.cut(low), text.cut(high)
            prefix, middle, suffix = data[:x], data[x:y], data[y:]
            prefix_chars.append(x_chars), middle_chars.append(y_chars - x_chars)
            if h4 % 100 < spm_percent:
                form.append("spm"), out.append(b"".join((second, suffix, first, prefix, third, middle)))
            else:
                form.append("psm"), out.append(b"".join((first, prefix, second, suffix, third, middle)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64()),
             pa.array(middle_chars, pa.int64()), pa.array(out, pa.binary()).view(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "fim_text"])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, percent: int = PERCENT,
              spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, fim_text`` of every row:
    lines, form (plain, psm or spm), code points of prefix and middle (null if
    plain), and the transformed text.

    Cuts and form are drawn from the SHA-256 of seed and id, so reruns agree
    and rows that repeat an id are cut by the same draws. A null id is drawn as
    an empty one. A null text counts as empty; it, texts with a sentinel, and
    the share of texts beyond ``percent`` stay plain. A text of any length is
    cut whole. An empty table gives an empty result; no other column is read.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    hex_ = F.sha2(name.cast("binary"), 256)
    draws = [F.conv(F.substring(hex_, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"), *draws)
    marks = tuple(s.encode() for s in sentinels)

    def cuts(batches):
        return _cuts(batches, percent, spm_percent, marks)

    return rows.mapInArrow(cuts, "doc_id long, n long, form string, prefix_chars long, middle_chars long, fim_text string")


def restored(form: Column, text: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text before its transformation. Sentinels occur once each, since a
    text that holds one stays plain and no piece can make up one at its edge."""
    first, second, third = sentinels
    middle, head = F.substring_index(text, third, -1), F.substring_index(text, third, 1)
    before, after = F.substring_index(head, second, 1), F.substring_index(head, second, -1)
    psm = F.concat(F.substring_index(before, first, -1), middle, after)
    spm = F.concat(F.substring_index(after, first, -1), middle, F.substring_index(after, first, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def oracle_sql(seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT,
               sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> str:
    """The same cuts in DuckDB SQL, from the list of lines."""
    p, s, m = sentinels
    draws = ", ".join(f"('0x' || substr(hex, {1 + 8 * k}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
    WITH units AS (SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                          sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
    drawn AS (SELECT doc_id, body, lines, len(lines)::BIGINT AS n, {draws} FROM units),
    cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
                   CASE WHEN body = '' OR contains(body, '{p}') OR contains(body, '{s}') OR contains(body, '{m}') OR h3 % 100 >= {percent}
                        THEN 'plain' WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (SELECT *, array_to_string(lines[1:x], '') AS a, array_to_string(lines[x + 1:y], '') AS b, array_to_string(lines[y + 1:], '') AS c
              FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN concat('{p}', a, '{s}', c, '{m}', b) WHEN 'spm' THEN concat('{s}', c, '{p}', a, '{m}', b)
                  ELSE body END) AS output_sha256,
           sha256(body) AS restored_sha256
    FROM parts"""
