"""Language-model scores by masked pseudo-likelihood.

Every token of a text is predicted from its neighbours on both sides (two each way), as if it were
masked; the sum of the conditional log-probabilities scores the document.

* *Vocabulary.* Word counts over all documents: each task counts its own words, Spark sums them. The most
  frequent words are tokens of their own; every other word is one of 64 rare tokens by length and script, so
  each word of a text is predicted.
* *Network.* Position-wise embeddings of the four neighbours are summed and passed through tanh; the
  output is a two-level softmax (class, then word within the class), so a prediction costs two short
  softmaxes instead of one over the vocabulary.
* *Training.* In each round every task starts from the shared weights, trains on one in ``step`` positions
  of all its documents, and emits its weights times its examples; Spark sums the
  rows per weight vector, which makes the average the next round starts from. Rounds take the
  positions in turn, so ``step`` rounds train on every position once (the default).

Defined cases: null, empty and blank texts have no tokens: sum 0.0, mean null. Repeated rows score
alike; a text's sum depends on the text and the model alone. A very long text
is a slice of its own and scored in chunks of tokens. Null ids are kept. An empty table gives an empty result. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import small_batches, written
from shopflow.llm.text import hash_spans, lean, slices, words

CLASSES, PER_CLASS = 48, 48
VOCAB = CLASSES * PER_CLASS         # tokens, of which the first RARE are buckets of rare words
RARE = 64
WIDTH = 16
OFFSETS = (-2, -1, 1, 2)
ROUNDS, STEP, BATCH, RATE = 2, 2, 512, 0.1   # as many rounds as steps: every position trains once
CHUNK = 1 << 12
KEEP = 1 << 21                      # words a task holds before it hands its counts on
LIMIT = 4.0                         # of a weight's size, so logits stay below 17 * LIMIT and exp is finite
PAD = VOCAB                         # the embedding row of positions outside a text
BLOCK = 16                          # positions of one class that a training step multiplies at once

_TABLES = np.arange(len(OFFSETS)) * (VOCAB + 1)     # first row of each neighbour's embedding table
_ONES = np.ones(PER_CLASS, dtype=np.float32)        # a product with it sums rows faster than sum()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    todo: list[np.ndarray] = []

    def fold() -> None:
        nonlocal keys, counts, todo
        k, inv = np.unique(np.concatenate([keys, *todo]), return_inverse=True)
        c = np.bincount(inv[len(keys):], minlength=len(k)).astype(np.int64)
        np.add.at(c, inv[:len(keys)], counts)
        keys, counts, todo = k, c, []

    def part() -> pa.RecordBatch:
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for b in batches:
        for _, _, data, off in slices(b.column(0)):
            starts, ends, _ = words(data, off)
            todo.append(hash_spans(data, starts, ends))
            if sum(map(len, todo)) > KEEP:
                fold()
                if len(keys) > KEEP:  # Spark sums the parts
                    yield part()
                    keys, counts = keys[:0], counts[:0]
    if todo:
        fold()
    yield part()


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Hashes of the VOCAB - RARE most frequent words, most frequent first (counts over all documents)."""
    counts = docs.select("text").mapInArrow(lean(_word_counts), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(VOCAB - RARE).toPandas()
    return top["word"].to_numpy(dtype=np.int64).view(np.uint64)


class Model:
    """Weights: four embedding tables, class vectors and biases, word vectors and biases."""

    NAMES = ("emb", "cls", "out")

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.emb = (rng.standard_normal((len(OFFSETS) * (VOCAB + 1), WIDTH + 1)) * 0.1).astype(np.float32)
        self.emb[:, -1] = 0
        self.cls = np.zeros((CLASSES, WIDTH + 1), dtype=np.float32)     # last column: bias
        self.out = np.zeros((VOCAB, WIDTH + 1), dtype=np.float32)

    def rows(self) -> np.ndarray:
        return np.concatenate([self.emb, self.cls, self.out])

    @classmethod
    def of(cls, rows: np.ndarray) -> Model:
        m = cls.__new__(cls)
        a, b = len(OFFSETS) * (VOCAB + 1), len(OFFSETS) * (VOCAB + 1) + CLASSES
        m.emb, m.cls, m.out = rows[:a].copy(), rows[a:b].copy(), rows[b:].copy()
        return m

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        """The hidden layer of every context, with a last column of ones for the biases."""
        at = ctx + _TABLES
        h = self.emb.take(at[:, 0], axis=0)
        for k in range(1, len(OFFSETS)):
            h += self.emb.take(at[:, k], axis=0)
        np.tanh(h, out=h)
        h[:, WIDTH] = 1
        return h

    def log_prob(self, ctx: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of every target given its neighbours; targets of one class share a product."""
        out = np.zeros(len(target), dtype=np.float64)
        for a in range(0, len(target), CHUNK):
            c = (target[a:a + CHUNK] // PER_CLASS).astype(np.uint8)
            o = np.argsort(c, kind="stable")
            t, c = target[a:a + CHUNK][o], c[o].astype(np.int64)
            at_row = np.arange(len(t))
            h = self.hidden(ctx[a:a + CHUNK][o])
            z = h @ self.cls.T
            p = z[at_row, c]
            np.exp(z, out=z)  # logits are bounded by LIMIT
            p -= np.log(z @ _ONES[:CLASSES])
            cuts = np.searchsorted(c, np.arange(CLASSES + 1)).tolist()
            z = np.empty((len(t), PER_CLASS), dtype=np.float32)
            for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if y > x:
                    np.matmul(h[x:y], self.out[k * PER_CLASS:(k + 1) * PER_CLASS].T, out=z[x:y])
            p += z[at_row, t - c * PER_CLASS]
            np.exp(z, out=z)
            p -= np.log(z @ _ONES)
            out[a + o] = p
        return out

    def train(self, ctx: np.ndarray, target: np.ndarray, state: list[np.ndarray]) -> None:
        """One AdaGrad step on a batch. Targets of one class stand in blocks of their own (padded with zero
        rows, which add nothing), so a few products over all blocks serve every class."""
        n = len(target)
        c = (target // PER_CLASS).astype(np.uint8)
        o = np.argsort(c, kind="stable")
        ctx, c, within = ctx[o], c[o].astype(np.int64), target[o] % PER_CLASS
        h = self.hidden(ctx)
        g = h @ self.cls.T
        np.exp(g, out=g)  # logits are bounded by LIMIT
        g /= (g @ _ONES[:CLASSES])[:, None]
        g[np.arange(n), c] -= 1
        dh = g @ self.cls

        count = np.bincount(c, minlength=CLASSES)
        blocks = -(-count // BLOCK)
        first = np.cumsum(blocks) - blocks  # block of a class
        at = np.arange(n) + (first * BLOCK - np.cumsum(count) + count)[c]
        w = self.out.reshape(CLASSES, PER_CLASS, WIDTH + 1)[np.repeat(np.arange(CLASSES), blocks)]
        x = np.zeros((len(w) * BLOCK, WIDTH + 1), dtype=np.float32)
        x[at] = h
        xs = x.reshape(len(w), BLOCK, WIDTH + 1)
        us = xs @ w.transpose(0, 2, 1)
        np.exp(us, out=us)
        us /= (us @ _ONES)[:, :, None]
        u = us.reshape(len(x), PER_CLASS)
        u[at, within] -= 1
        dh += (us @ w).reshape(len(x), WIDTH + 1)[at]
        grad = (us.transpose(0, 2, 1) @ xs)[np.minimum(first, len(w) - 1)]
        grad[count == 0] = 0
        for k in np.flatnonzero(blocks > 1).tolist():
            rows = slice(first[k] * BLOCK, (first[k] + blocks[k]) * BLOCK)
            np.matmul(u[rows].T, x[rows], out=grad[k])
        grad /= n
        self._step(self.out, state[2], grad.reshape(VOCAB, WIDTH + 1))  # no gradient, no step
        self._step(self.cls, state[1], g.T @ h / n)

        h *= h
        dh *= np.subtract(1, h, out=h)  # nothing flows through the column of ones
        at = (ctx + _TABLES).ravel().astype(np.uint16)
        o = np.argsort(at, kind="stable")
        at = at[o]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        grad = np.add.reduceat(dh.take(o // len(OFFSETS), axis=0), first, axis=0)
        grad /= n
        rows = at[first].astype(np.int64)
        w, s = self.emb.take(rows, axis=0), state[0].take(rows, axis=0)
        self._step(w, s, grad)
        self.emb[rows], state[0][rows] = w, s

    @staticmethod
    def _step(w: np.ndarray, s: np.ndarray, grad: np.ndarray) -> None:
        q = grad * grad
        s += q
        np.sqrt(s, out=q)
        grad *= RATE
        grad /= q
        w -= grad
        np.maximum(w, -LIMIT, out=w)
        np.minimum(w, LIMIT, out=w)


class Vocabulary:
    """Word hash to token: keys in order, found by their first 16 bits."""

    def __init__(self, top: np.ndarray) -> None:
        o = np.argsort(top)
        self.keys, self.token = top[o], (np.arange(len(top)) + RARE)[o]
        heads = np.arange((1 << 16) + 1)
        self.first = np.searchsorted((self.keys >> np.uint64(48)).astype(np.int64), heads)
        self.deep = int(np.diff(self.first).max())  # most keys with the same head

    def tokens(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = hash_spans(data, starts, ends)
        out = np.minimum(ends - starts, 32) - 1
        high = data >= 128
        if high.any():
            wide = np.concatenate(([0], np.cumsum(high)))
            out += 32 * (wide[ends] > wide[starts])
        if not len(self.keys):
            return out
        k = self.first[(h >> np.uint64(48)).astype(np.int64)]
        for step in range(self.deep):
            at = np.minimum(k + step, len(self.keys) - 1)
            out = np.where(self.keys[at] == h, self.token[at], out)
        return out


def contexts(tokens: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The neighbours of every token; PAD outside its text."""
    ctx = np.full((len(tokens), len(OFFSETS)), PAD, dtype=np.int64)
    for k, d in enumerate(OFFSETS):
        a, b = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
        ctx[a, k] = np.where(row[a] == row[b], tokens[b], PAD)
    return ctx


def _train(top_b, rows_b, step: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = Vocabulary(top_b.value), Model.of(rows_b.value)
        start = model.rows()
        state = [np.full_like(w, 1e-4) for w in (model.emb, model.cls, model.out)]
        held_c, held_t, n = [], [], 0

        def learn(all_: bool) -> None:
            nonlocal held_c, held_t
            c, t = np.concatenate(held_c), np.concatenate(held_t)
            o = np.random.default_rng(len(t)).permutation(len(t))
            c, t = c[o], t[o]
            cut = len(t) if all_ else len(t) // BATCH * BATCH
            for a in range(0, cut, BATCH):
                model.train(c[a:min(a + BATCH, cut)], t[a:min(a + BATCH, cut)], state)
            held_c, held_t = [c[cut:]], [t[cut:]]

        for b in batches:
            for _, _, data, off in slices(b.column(0)):
                starts, ends, row = words(data, off)
                if not len(starts):
                    continue
                first = np.searchsorted(row, np.arange(len(off) - 1))
                place = np.arange(len(row)) - first[row]
                at = np.flatnonzero((place + np.diff(off)[row] + turn) % step == 0)  # each text has its own phase
                if not len(at):
                    continue
                t = vocab.tokens(data, starts, ends)
                held_c.append(contexts(t, row)[at])
                held_t.append(t[at])
                n += len(at)
                if sum(map(len, held_t)) > 64 * BATCH:
                    learn(False)
        if held_t:
            learn(True)
        now = model.rows()
        at = np.flatnonzero((now != start).any(axis=1))
        if n and len(at):
            moved = (now[at].astype(np.float64) - start[at]) * n
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(np.full(len(at), float(n))),
                                   pa.array(moved.tolist(), pa.list_(pa.float64()))], names=["at", "n", "w"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the moves of every weight vector of a partition."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        w = np.asarray(b.column(2).flatten()).reshape(b.num_rows, WIDTH + 1)
        for at, n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), w):
            got = sums.setdefault(at, np.zeros(WIDTH + 2))
            got[0] += n
            got[1:] += v
    if sums:
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()],
                                                                           pa.list_(pa.float64()))], names=["at", "w"])


def fit(docs: DataFrame, rounds: int = ROUNDS, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary, weight rows)."""
    sc = docs.sparkSession.sparkContext
    top = vocabulary(docs)
    top_b, rows = sc.broadcast(top), Model().rows()
    for turn in range(rounds):
        rows_b = sc.broadcast(rows)
        moves = written(docs.select("text").mapInArrow(lean(_train(top_b, rows_b, step, turn)), "at int, n double, w array<double>"), "moves")
        # Every weight vector moves by the mean of the tasks that met it, weighted by their examples.
        got = moves.repartition("at").mapInArrow(_summed, "at int, w array<double>").toPandas()  # a row per weight vector
        if len(got):
            w = np.stack(got["w"].to_list())
            rows = rows.copy()
            rows[got["at"].to_numpy()] += (w[:, 1:] / w[:, :1]).astype(np.float32)
    return top, rows


def _score(top_b, rows_b):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = Vocabulary(top_b.value), Model.of(rows_b.value)
        for b in batches:
            n, total = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows)
            for first, rows, data, off in slices(b.column(1)):
                starts, ends, row = words(data, off)
                if len(starts):
                    t = vocab.tokens(data, starts, ends)
                    p = model.log_prob(contexts(t, row), t)
                    n[first:first + rows] = np.bincount(row, minlength=rows)
                    total[first:first + rows] = np.bincount(row, weights=p, minlength=rows)
            mean = pa.array(np.where(n > 0, total / np.maximum(1, n), 0.0), mask=n == 0)
            yield pa.record_batch([b.column(0), pa.array(n), pa.array(total), mean],
                                  names=["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    return run


def score(docs: DataFrame, rounds: int = ROUNDS, step: int = STEP) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) per row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    top, rows = fit(docs, rounds, step)
    sc = docs.sparkSession.sparkContext
    return docs.mapInArrow(lean(_score(sc.broadcast(top), sc.broadcast(rows))),
                           "doc_id long, n_tokens long, log_prob double, mean_log_prob double")
