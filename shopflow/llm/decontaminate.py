"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. The word n-grams (n = 3) of the test items are the seeds. One pass over all texts finds the seeds each
   document holds; every (document, item) pair that shares one is looked at, however many documents hold
   the seed, so a widely copied passage or edited form is never taken for a common phrase.
2. The windows around the seeds are aligned with the item: local alignment of words (match +2, mismatch -1,
   gap -1). ``score`` is the best alignment's share of the item's own score (2 per word); pairs from
   ``min_score`` on are leaks. A window that holds too few of the item's words to reach ``min_score`` even
   if all of them matched is not aligned; that bound loses nothing.

Texts are lower-cased; words are runs of ASCII letters, digits and non-ASCII characters; other
punctuation does not count.
Items go in blocks of bounded size, each block against all documents, so the seed table a task holds
is bounded whatever the benchmark's size.

Defined cases: null or word-less texts and items match nothing; items shorter than n words have one
seed, the whole item. Repeated items or documents give one row per distinct (key, item). Null ids of
documents and items are reported as null. Empty tables give an empty result. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import small_batches
from shopflow.llm.text import hash_spans, lean, mix64, ngrams, slices

SEED_WORDS = 3
MIN_SCORE = 0.45
BLOCK_BYTES = 8_000_000     # benchmark text per block

_B = np.arange(256)
_ALNUM = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)


def _tokens(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, row of each word) per slice."""
    for first, rows, data, off in slices(pc.utf8_lower(col)):
        w = _ALNUM[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[off] = True
        starts = np.flatnonzero(w & (edge[:-1] | np.concatenate(([True], ~w[:-1])))) if len(w) else off[:0]
        ends = np.flatnonzero(w & (edge[1:] | np.concatenate((~w[1:], [True])))) + 1 if len(w) else off[:0]
        yield first, rows, hash_spans(data, starts, ends), np.searchsorted(off, starts, side="right") - 1


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, rows, h, row in _tokens(pa.array(texts, pa.large_string())):
        cuts = np.searchsorted(row, np.arange(rows + 1))
        out += [h[cuts[r]:cuts[r + 1]] for r in range(rows)]
    return out


def _short(h: np.ndarray) -> np.ndarray:
    return mix64(np.array([h.sum() if len(h) else 0], dtype=np.uint64) + np.uint64(len(h)))


def _seeds_of(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return ngrams(h, np.zeros(len(h), dtype=np.int64), n)


class Items:
    """Words of one block of items and the sorted table of their seeds."""

    def __init__(self, ids: list, texts: list[str | None], n: int) -> None:
        kept = [(i, w) for i, w in zip(ids, item_words(texts)) if len(w)]
        self.n, self.ids, self.words = n, [i for i, _ in kept], [w for _, w in kept]
        seeds, items, pos = [], [], []
        for k, w in enumerate(self.words):
            m = min(n, len(w))
            g, at = _seeds_of(w, m)
            seeds.append(g), items.append(np.full(len(g), k)), pos.append(at)
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, dtype=t)
        s, self.item, self.pos = cat(seeds, np.uint64), cat(items, np.int64), cat(pos, np.int64)
        o = np.argsort(s, kind="stable")
        self.seed, self.item, self.pos = s[o], self.item[o], self.pos[o]
        self.lengths = sorted({min(n, len(w)) for w in self.words})

    @classmethod
    def of(cls, fields: dict) -> Items:
        """The items of a broadcast dictionary of fields (plain arrays and lists)."""
        items = cls.__new__(cls)
        vars(items).update(fields)
        return items

    def hits(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word index, index of the first table entry of the seed) of every seed held."""
        out = [(np.zeros(0, dtype=np.int64),) * 2]
        for m in self.lengths:
            g, at = ngrams(h, row, m)
            if len(g):
                k = np.minimum(np.searchsorted(self.seed, g), len(self.seed) - 1)
                ok = self.seed[k] == g
                out.append((at[ok], k[ok]))
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences and the window index where it ends."""
    j = np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        up = np.zeros_like(row)
        up[1:] = np.maximum(row[:-1] + np.where(window == w, 2, -1), row[1:] - 1)
        np.maximum(up, 0, out=up)
        row = np.maximum.accumulate(up + j) - j  # gaps in the item: -1 per skipped window word
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _align(items_b, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(items_b.value)
        for batch in batches:
            found: list[tuple] = []
            for first, rows, h, row in _tokens(batch.column(1)):
                at, k = items.hits(h, row)
                o = np.argsort(at, kind="stable")
                at, k = at[o], k[o]
                hit_cuts = np.searchsorted(row[at], np.arange(rows + 1))
                cuts = np.searchsorted(row, np.arange(rows + 1))
                for r in range(rows):
                    lo, hi = hit_cuts[r], hit_cuts[r + 1]
                    if hi == lo:
                        continue
                    spans: dict[int, list[tuple[int, int]]] = {}
                    for a, e in zip(at[lo:hi].tolist(), k[lo:hi].tolist()):
                        while True:  # all items that share the seed
                            it = int(items.item[e])
                            m = len(items.words[it])
                            begin = a - cuts[r] - int(items.pos[e]) - m // 2 - 2
                            spans.setdefault(it, []).append((int(begin), int(begin + 2 * m + 4)))
                            if e + 1 >= len(items.seed) or items.seed[e + 1] != items.seed[e]:
                                break
                            e += 1
                    text = h[cuts[r]:cuts[r + 1]]
                    for it, parts in spans.items():
                        parts.sort()
                        merged = [list(parts[0])]
                        for b, e in parts[1:]:
                            if b <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], e)
                            else:
                                merged.append([b, e])
                        full = 2 * len(items.words[it])
                        top = (0, 0)
                        for b, e in merged:
                            window = text[max(0, b):e]
                            if 2 * int(np.isin(items.words[it], window).sum()) < min_score * full:
                                continue
                            s, end = align(items.words[it], window)
                            top = max(top, (s, -(max(0, b) + end)))
                        if top[0] >= min_score * full:
                            found.append((first + r, items.ids[it], top[0] / full, -top[1]))
            if found:
                r, i, s, e = zip(*found)
                yield pa.record_batch([batch.column(0).take(pa.array(r, pa.int64())), pa.array(i, pa.int64()),
                                       pa.array(s, pa.float64()), pa.array(e, pa.int64())],
                                      names=["key", "item_id", "score", "end_word"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", min_score: float = MIN_SCORE,
          seed_words: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item_id, score, end_word): documents that hold a copy or edited copy of a test item.
    ``key`` names a long column of ``docs`` beside ``text``; ``end_word`` is where the best
    alignment ends, in words from the document's start."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = int((bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes) + 1
    out = None
    for b in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct() \
            .orderBy("item_id", "text").collect()  # one block: bounded by block_bytes on average
        items = Items([r[0] for r in part], [r[1] for r in part], seed_words)
        if not items.words:
            continue
        items_b = spark.sparkContext.broadcast(vars(items))
        found = docs.mapInArrow(lean(_align(items_b, min_score)),
                                "key long, item_id long, score double, end_word long")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], "key long, item_id long, score double, end_word long")
    return out.groupBy("key", "item_id").agg(F.max("score").alias("score"),
                                             F.max_by("end_word", F.struct("score", -F.col("end_word"))).alias("end_word")) \
        .withColumnRenamed("key", key)
