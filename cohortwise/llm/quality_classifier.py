"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of hashed features in three groups:
its words, its pairs of neighbouring words (pairs of equal words, and pairs
seen before in the text, share a bucket each), and the character n-grams of
its words with their borders. A softmax over two classes follows. Vectors and
softmax are trained together by stochastic gradient descent in numpy on a
sample of labelled rows bounded in rows and bytes (``SAMPLE``,
``SAMPLE_BYTES``); everything else covers all rows.

The output is linear in the averaged vectors, so for scoring every bucket is
reduced to one number, its vector's share of the logit. That table, whose size
is fixed, is broadcast, and every whole text is scored in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortwise.llm.kernels import SPACE, U64, Words, mix, slices
from cohortwise.llm.storage import written

#: Labelled rows used for training, at most; taken in the order of a hash of their ids.
SAMPLE = 4000
#: Bytes of their sparse features that the driver takes, at most; rows beyond are left out in the same order.
SAMPLE_BYTES = 128 << 20
#: Text bytes whose features are made at once: their arrays take over a hundred times as much.
SLICE_BYTES = 1 << 20
BUCKETS = 1 << 16
DIMENSIONS = 10
EPOCHS, BATCH, RATE = 4, 32, 0.15
NGRAMS = (3, 4, 5)
GROUPS = 3
#: Buckets of a pair of equal words, and of a pair seen before in the text.
SAME_PAIR, SEEN_PAIR = 0, 1
THRESHOLD = 0.7
SEED = 7


def fold(id_col: Column) -> Column:
    """CRC-32 of the id as text, modulo 4; null ids fall into fold 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)), F.lit(0))


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, index of the text) of the features of each group in turn,
    buckets of different groups being apart; in the order of the texts."""
    words = Words(column)
    n = len(words.start)
    texts = np.repeat(np.arange(len(words.count)), words.count)
    yield (words.hash % U64(BUCKETS)).astype(np.int64), texts

    pairs, valid = words.windows(2)
    at = np.flatnonzero(valid)
    buckets = (pairs[at] % U64(BUCKETS - 2)).astype(np.int64) + 2
    own = mix(pairs[at] ^ (texts[at].astype(U64) * U64(0x9E3779B97F4A7C15)))  # the pair within its text
    order = np.argsort(own, kind="stable")
    seen = np.zeros(len(at), bool)
    seen[order[1:]] = own[order[1:]] == own[order[:-1]]
    buckets[seen] = SEEN_PAIR
    buckets[words.hash[at] == words.hash[np.minimum(at + 1, max(n - 1, 0))]] = SAME_PAIR
    yield buckets + BUCKETS, texts[at]

    raw = words.raw
    space = SPACE[raw]
    byte = np.where(space, np.uint8(32), raw).astype(np.uint32)
    owner = np.repeat(np.arange(len(words.count), dtype=np.int32), np.diff(words.offsets))
    found, whose = [], []
    for size in NGRAMS:
        last = len(raw) - size + 1
        if last <= 0:
            continue
        code, good = np.full(last, np.uint32(size)), owner[:last] == owner[size - 1:]
        for k in range(size):
            code = code * np.uint32(0x01000193) + byte[k:last + k]
            if 0 < k < size - 1:
                good &= ~space[k:last + k]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(13)
        keep = np.flatnonzero(good)
        found.append((code[keep] % np.uint32(BUCKETS)).astype(np.int64))
        whose.append(owner[keep])
    if found:
        whose = np.concatenate(whose)
        order = np.argsort(whose, kind="stable")
        yield np.concatenate(found)[order] + 2 * BUCKETS, whose[order]


def _sparse(batches):
    """Distinct buckets and their weights, as bytes, of every text."""
    for batch in slices(batches, "_text", SLICE_BYTES):
        rows = [([], []) for _ in range(batch.num_rows)]
        for buckets, texts in features(batch.column(1)):
            bounds = np.searchsorted(texts, np.arange(batch.num_rows + 1))
            for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                if b > a:
                    values, counts = np.unique(buckets[a:b], return_counts=True)
                    rows[i][0].append(values.astype(np.int32))
                    rows[i][1].append((counts / (GROUPS * (b - a))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array([np.concatenate(r[k]).tobytes() if r[k] else b"" for r in rows], pa.binary())
                                 for k in (0, 1)] + [batch.column(2)], names=["label", "buckets", "weights", "rank"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> tuple[np.ndarray, float]:
    """(logit share of every bucket, bias) for label 1 against label 0.

    ``examples``: label, buckets, weights. Without examples of both labels
    every share is zero, and the bias follows the labels there are.
    """
    size = GROUPS * BUCKETS
    ones = sum(label for label, _, _ in examples)
    if not 0 < ones < len(examples):
        return np.zeros(size, np.float32), 0.0 if not examples else (4.0 if ones else -4.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.5, 0.5, (size, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    top = rng.uniform(-0.5, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_vectors, seen_top, seen_bias = np.full(size, 1e-8, np.float32), np.full_like(top, 1e-8), np.full_like(bias, 1e-8)
    labels = np.array([label for label, _, _ in examples])
    for epoch in range(epochs):
        order = rng.permutation(len(examples))
        step = rate * (1 - epoch / epochs)
        for start in range(0, len(order), BATCH):
            part = order[start:start + BATCH]
            lengths = np.array([len(examples[i][1]) for i in part])
            buckets = np.concatenate([examples[i][1] for i in part])
            weights = np.concatenate([examples[i][2] for i in part])
            row = np.repeat(np.arange(len(part)), lengths)
            hidden = np.zeros((len(part), DIMENSIONS), np.float32)
            for d in range(DIMENSIONS):
                hidden[:, d] = np.bincount(row, vectors[buckets, d] * weights, len(part))
            logits = hidden @ top + bias
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(part)), labels[part]] -= 1
            error /= len(part)
            back = error @ top.T
            for value, seen, slope in ((top, seen_top, hidden.T @ error), (bias, seen_bias, error.sum(axis=0))):
                seen += slope * slope
                value -= step * slope / np.sqrt(seen)
            touched, place = np.unique(buckets, return_inverse=True)
            slopes = np.empty((len(touched), DIMENSIONS), np.float32)
            for d in range(DIMENSIONS):
                slopes[:, d] = np.bincount(place, weights * back[row, d], len(touched))
            seen_vectors[touched] += (slopes * slopes).mean(axis=1)
            vectors[touched] -= step * slopes / np.sqrt(seen_vectors[touched])[:, None]
    return vectors @ (top[:, 1] - top[:, 0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_bytes: int = SAMPLE_BYTES) -> tuple[np.ndarray, float]:
    """The model from at most ``sample`` labelled rows outside the held-out fold.

    Null ids and labels other than 0 and 1 are left out. The sample's sparse
    features are written to the shared folder; of these, whole rows of at most
    ``sample_bytes`` reach the driver, so long texts make a smaller sample.
    """
    order = Window.orderBy(F.xxhash64("_lid"), "_lid", "label")
    chosen = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("label")).where(
        F.col("_lid").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("_lid")) != 2)
    ).distinct().orderBy(F.xxhash64("_lid"), "_lid", "label").limit(sample).withColumn("rank", F.row_number().over(order))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("_lid")).select("label", "_text", "rank")  # ``chosen`` has at most ``sample`` rows
    found = written(rows.mapInArrow(_sparse, "label int, buckets binary, weights binary, rank int"), "sparse")
    sizes = found.groupBy("rank").agg(F.sum(F.octet_length("buckets") + F.octet_length("weights")).alias("bytes")).orderBy("rank")
    last, held = 0, 0
    for r in sizes.collect():  # at most ``sample`` numbers
        held += r["bytes"]
        if held > sample_bytes:
            break
        last = r["rank"]
    taken = found.where(F.col("rank") <= last).select("label", "buckets", "weights").toArrow()
    examples = sorted((r["label"], r["buckets"], r["weights"]) for r in taken.to_pylist())  # whatever the task order
    return train([(label, np.frombuffer(b, np.int32), np.frombuffer(w, np.float32)) for label, b, w in examples])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: the probability of label 1.

    Null, empty and blank texts get the score of the bias alone. Null ids and
    repeated rows pass through; an empty table gives an empty result; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        table, bias = shared.value
        for batch in slices(batches, "_text", SLICE_BYTES):
            logit = np.full(batch.num_rows, bias)
            for buckets, texts in features(batch.column(1)):
                total = np.bincount(texts, table[buckets], batch.num_rows)
                logit += total / (GROUPS * np.maximum(np.bincount(texts, minlength=batch.num_rows), 1))
            probability = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = score(docs, fit(docs, labels, **options))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
