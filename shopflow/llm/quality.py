"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader.

Words are runs of letters, digits and bytes above 127, or runs of other non-space bytes, so marks glued
to words count as words of their own; unigrams and bigrams are hashed to 2**18 weights, and all bigrams
of a word with itself share one. A text's features are its n-gram counts over their number (times a constant), so the score, a sparse dot
product of features and weights through the logistic function, does not depend on length.

Training (FTRL-Proximal, one pass per epoch in hash order) takes at most ``max_train`` labelled rows
that are not held out, chosen by hash: a documented bound, so one task can train. Scoring is a map
over all rows with the weights broadcast (2**18 floats, 1 MB).

Defined cases: null and empty texts have no features and score by the bias alone. A document with
several labels trains with each; rows with null labels do not train. With no labelled rows every score
is 0.5. Repeated rows score alike. Extra columns stay in :func:`scored`; its added ones replace
their namesakes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import small_batches
from shopflow.llm.text import IS_WORD, hash_spans, lean, mix64, slices

BUCKET_BITS = 18
MAX_TRAIN = 10_000
EPOCHS = 3
THRESHOLD = 0.3
SCALE = 40.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.0005, 0.0005

_B = np.arange(256)
_LETTER = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_CLASS = np.where(~IS_WORD, 0, np.where(_LETTER, 1, 2)).astype(np.uint8)

_TWICE = np.uint64(0x2545F4914F6CDD1D)  # the bigram of any word with itself


def _features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, n-gram buckets, row of each) per slice."""
    for first, rows, data, off in slices(col):
        kind = _CLASS[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[off] = True
        if len(data):
            edge[1:-1] |= kind[1:] != kind[:-1]
        cut = np.flatnonzero(edge)
        starts, ends = cut[:-1], cut[1:]
        w = kind[starts] > 0 if len(starts) else np.zeros(0, dtype=bool)
        starts, ends = starts[w], ends[w]
        row = np.searchsorted(off, starts, side="right") - 1
        h = hash_spans(data, starts, ends, lower=False)
        two = np.flatnonzero(row[:-1] == row[1:])
        pair = mix64(h[two] * np.uint64(3) + h[two + 1])
        pair[h[two] == h[two + 1]] = _TWICE
        yield (first, rows, (np.concatenate([h, pair]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64),
               np.concatenate([row, row[two]]))


def train(texts: Iterator[pa.Array], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias. Texts come in pieces and are read in the order given."""
    data: list[tuple[np.ndarray, np.ndarray]] = []
    for _, rows, bucket, row in (f for piece in texts for f in _features(piece)):
        o = np.argsort(row, kind="stable")
        bucket, cuts = bucket[o], np.searchsorted(row[o], np.arange(rows + 1))
        for r in range(rows):
            i, c = np.unique(bucket[cuts[r]:cuts[r + 1]], return_counts=True)
            data.append((i.astype(np.int32), (SCALE * c / max(1, c.sum())).astype(np.float32)))
    size = 1 << BUCKET_BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for (i, x), y in zip(data, labels):
            i, x = np.append(i, size), np.append(x, 1.0).astype(np.float64)
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            g2 = g * g
            z[i] += g - (np.sqrt(n[i] + g2) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g2
    w = weights(np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def score(texts: pa.Array, w: np.ndarray, bias: float) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, rows, bucket, row in _features(texts):
        total = np.bincount(row, weights=w[bucket], minlength=rows)
        out[first:first + rows] = SCALE * total / np.maximum(1, np.bincount(row, minlength=rows))
    return 1.0 / (1.0 + np.exp(-np.clip(out + bias, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text is divisible by 5 (null ids: held out) never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Weights and bias from documents joined with their labels (doc_id, quality)."""
    small_batches(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_train)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(sample), "doc_id") \
        .select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = [b for b in batches if b.num_rows]
        if not t:
            return
        t = pa.Table.from_batches(t)
        o = pc.sort_indices(t.select(["h", "doc_id", "quality"]), [("h", "ascending"), ("doc_id", "ascending"), ("quality", "ascending")])
        w, b = train((t.column("text").take(o.slice(k, 512)) for k in range(0, len(o), 512)), t.column("quality").take(o).to_numpy())
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(w[at].astype(np.float64), b))],
                              names=["at", "w"])

    model = rows.repartition(1).mapInArrow(lean(run), "at long, w double").toPandas()  # at most 2**18 + 1 rows
    w = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
    at = model["at"].to_numpy()
    w[at[at >= 0]] = model["w"].to_numpy()[at >= 0]
    return w, float(model["w"][at == -1].sum())


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
           max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; all other columns as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))

    @F.arrow_udf("double")
    def rate(text: pa.Array) -> pa.Array:
        return pa.array(score(text, *model.value))

    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    out = docs.select(*keep, rate(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score(b.column(1), *model.value)
            yield pa.record_batch([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                  names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(lean(run), "doc_id long, score double, predicted int") \
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
