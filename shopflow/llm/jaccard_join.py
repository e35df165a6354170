"""Near duplicates by a size-aware heavy-light join on word shingles (5 words, Jaccard >= 0.8).

A document's set holds its distinct 5-word shingles (words as in :mod:`shopflow.llm.text`; fewer
words: the whole sequence as one shingle). Steps, each a Spark job over all documents:

1. *Profile.* Set size and a 64-bit digest of the set per document. Equal sets are one class, whose
   copies take no further part. Every task also reports the shingles that several of its classes
   hold; those common overall sort last in the element order. The order only decides how long the
   lists get, never what is found.
2. *Boundary.* Linked sets share at least ceil(0.8 n) elements, so with the elements of both in one
   order they share one of their first ``p = n - ceil(0.8 n) + 1`` and two of their first ``p + 1``.
   A light set is listed under every 2-subset of its first p + 1 elements, a heavy one under each
   single one of its first p. The set size that parts light from heavy minimises the estimated
   cost: subsets to enumerate against list entries times the mean list length (as profiled). Light
   sets that can link to heavy ones are listed in both ways.
   An element's place in the set's order bounds the overlap of pairs it could be the first common
   element of; entries that no set in their list can be linked by are left out.
3. *Stars.* Every class of a list is compared, on whole texts, with one class only: the one with most
   list entries, which for edited copies is their original. Links give components.
4. *Rest.* Lists that still hold several components compare the classes across components (sizes
   permitting), so no link that could join two components is lost, while a list of mutual copies
   never emits its pairs.

Defined cases: null, empty and word-less texts have empty sets and link with nothing (component =
own doc_id). Repeated rows are copies of one another. A null doc_id gets a null component unless a
copy or link has an id. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.components import components
from shopflow.llm.store import collected, dropped, small_batches, written
from shopflow.llm.text import SHINGLE_WORDS, lean, mix64, shingle_sets

HOT_LEAST = 3           # a task reports shingles that so many of its classes hold
HOT_MOST = 1 << 19      # at most so many common shingles are ordered last (an 8 MB broadcast)
HOT_KEEP = 1 << 20      # shingles a task keeps before it forgets those seen once
LIGHT_MOST = 64         # no set above this size is ever light
BROADCAST_IDS = 4_000_000

_SALT_SUBSET = np.uint64(0x5851F42D4C957F2D)


def _digest(s: np.ndarray) -> int:
    """Order-free 64-bit digest of a set."""
    d = mix64(np.array([mix64(s).sum(), np.bitwise_xor.reduce(mix64(s + np.uint64(1))), len(s)], dtype=np.uint64))
    return int(mix64(d[:1] + d[1:2] * np.uint64(3) + d[2:] * np.uint64(5)).view(np.int64)[0])


def _profile(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        todo: list[np.ndarray] = []
        held = 0

        def fold() -> None:
            nonlocal keys, counts, todo, held
            k, inv = np.unique(np.concatenate([keys, *todo]), return_inverse=True)
            c = np.zeros(len(k), dtype=np.int64)
            np.add.at(c, inv[:len(keys)], counts)
            c += np.bincount(inv[len(keys):], minlength=len(k))
            keys, counts, todo, held = k, c, [], 0

        for batch in batches:
            n, cls = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
            for r, s in shingle_sets(batch.column(1), shingle_words):
                n[r] = len(s)
                if len(s):
                    cls[r] = d = _digest(s)
                    if d not in seen:
                        seen.add(d)
                        todo.append(s)
                        held += len(s)
                        if held > HOT_KEEP:
                            fold()
                            if len(keys) > HOT_KEEP:
                                keys, counts = keys[counts > 1], counts[counts > 1]
            yield pa.record_batch([pa.array(np.zeros(len(n), dtype=np.int8)), batch.column(0).cast(pa.int64()),
                                   pa.array(n), pa.array(cls)], names=["kind", "id", "n", "cls"])
        if todo:
            fold()
        total, squares = int(counts.sum()), int((counts * counts).sum())
        often = counts >= HOT_LEAST
        keys, counts = keys[often], counts[often]
        m = len(keys)
        yield pa.record_batch([pa.array(np.full(m, 1, dtype=np.int8)), pa.array(keys.view(np.int64)),
                               pa.array(counts), pa.array(np.zeros(m, dtype=np.int64))],
                              names=["kind", "id", "n", "cls"])
        yield pa.record_batch([pa.array([2], pa.int8()), pa.array([0], pa.int64()), pa.array([total], pa.int64()),
                               pa.array([squares], pa.int64())], names=["kind", "id", "n", "cls"])

    return run


def prefix_length(n: int) -> int:
    """Elements of a set of n that a linked set must share one of."""
    return n - (4 * n + 4) // 5 + 1


def light_boundary(sizes: dict[int, int], mean_others: float) -> int:
    """The largest size (up to LIGHT_MOST) that is cheaper to enumerate than to scan, given the number
    of classes per size and the mean number of other classes in a list."""
    best, best_cost = 3, None
    for x in range(3, LIGHT_MOST + 1):
        cost = 0.0
        for n, c in sizes.items():
            p = prefix_length(n)
            if n <= x:
                cost += c * p * (p + 1) / 2
            if 5 * n > 4 * x:
                cost += c * p * (1 + mean_others)
        if best_cost is None or cost < best_cost:
            best, best_cost = x, cost
    return best


def _ordered(s: np.ndarray, hot: np.ndarray, rank: np.ndarray, p: int) -> np.ndarray:
    """The first p elements of a set: by hash, the common ones last and from rare to common."""
    if not len(hot):
        return s[:p]
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    cold = s[~is_hot]
    if len(cold) >= p:
        return cold[:p]
    warm = s[is_hot]
    return np.concatenate([cold, warm[np.argsort(rank[at[is_hot]], kind="stable")]])[:p]


def _postings(shingle_words: int, boundary: int, hot_b):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = hot_b.value
        seen: set[int] = set()
        for batch in batches:
            tokens, owners, sizes, places = [], [], [], []

            def put(t: np.ndarray, d: int, n: int, at: np.ndarray) -> None:
                tokens.append(t.view(np.int64))
                owners.append(np.full(len(t), d, dtype=np.int64))
                sizes.append(np.full(len(t), n, dtype=np.int32))
                places.append(at.astype(np.int32))

            for _, s in shingle_sets(batch.column(0), shingle_words):
                n = len(s)
                if n <= 3:  # only equal sets reach 0.8 here, and those are one class
                    continue
                d = _digest(s)
                if d in seen:
                    continue
                seen.add(d)
                p = prefix_length(n)
                first = _ordered(s, hot, rank, p + 1)
                if 5 * n > 4 * boundary:
                    put(first[:p], d, n, np.arange(p))
                if n <= boundary:
                    i, j = np.triu_indices(len(first), 1)
                    lo, hi = np.minimum(first[i], first[j]), np.maximum(first[i], first[j])
                    put(mix64(lo * _SALT_SUBSET + hi), d, n, np.zeros(len(lo)))
            if tokens:
                yield pa.record_batch([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(owners)),
                                       pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                                      names=["token", "cls", "n", "pos"])

    return run


def _verify(shingle_words: int):
    """(a, b, text_a, text_b) -> linked pairs; one side's set is reused while it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), dtype=bool)
            right = batch.column(3)
            for r, s in shingle_sets(batch.column(2), shingle_words):
                if b[r] != last_key:
                    last_key, last = b[r], next(shingle_sets(right.slice(r, 1), shingle_words))[1]
                both = np.concatenate([s, last])
                both.sort()
                inter = int((both[1:] == both[:-1]).sum())
                keep[r] = 100 * inter >= 80 * (len(both) - inter)
            yield pa.record_batch([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return run


def set_digests(rows: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, cls, text) for rows (key, text): the class of every text that has shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = [(r, _digest(s)) for r, s in shingle_sets(b.column(1), shingle_words) if len(s)]
            if cls:
                at = pa.array([r for r, _ in cls], pa.int64())
                yield pa.record_batch([b.column(0).take(at), pa.array([d for _, d in cls], pa.int64()), b.column(1).take(at)],
                                      names=["key", "cls", "text"])

    return rows.select("key", "text").mapInArrow(lean(run), "key long, cls long, text string")


def _may_link(n: str, pos: str, m: str, other: str) -> str:
    """Whether sets of n and m elements can be linked with their first common element at these places."""
    return f"5 * {n} >= 4 * {m} and 5 * {m} >= 4 * {n} and 9 * least({n} - {pos}, {m} - {other}) >= 4 * ({n} + {m})"


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """Pairs of classes (a, b) whose sets reach the similarity, checked on the texts of one document
    per class."""
    pairs = written(pairs, "pairs")
    need = written(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
                   .join(reps, "cls").select("cls", "doc_id"), "need")
    n_need, named = need.count(), need.where("doc_id is not null")
    n_named = named.count()
    texts = written(docs.join(F.broadcast(named) if n_named <= BROADCAST_IDS else named, "doc_id").select("cls", "text"), "texts")
    if texts.count() > n_named:  # an id on several rows, whose texts may differ; otherwise the texts need no shuffle
        own = set_digests(texts.withColumnRenamed("cls", "key"), shingle_words).where("key = cls")
        texts = written(own.select("cls", "text").dropDuplicates(["cls"]), "texts")
    if n_need > n_named:  # classes without any id, found by their sets
        rest = need.where("doc_id is null").select("cls")
        own = set_digests(docs.where("doc_id is null").select(F.lit(0).cast("long").alias("key"), "text"), shingle_words)
        own = own.join(F.broadcast(rest) if n_need - n_named <= BROADCAST_IDS else rest, "cls", "left_semi")
        texts = written(texts.union(own.select("cls", "text").dropDuplicates(["cls"])), "texts")
    j = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b") \
        .select("a", "b", "text_a", "text_b")
    linked = written(j.mapInArrow(lean(_verify(shingle_words)), "a long, b long"), "linked")
    dropped(pairs.sparkSession, pairs, need, texts)
    return linked


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_size) for every row of ``docs`` (doc_id, text)."""
    return grouped(docs, shingle_words).drop("cls")


def grouped(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """:func:`near_duplicates` with the class of every row (``cls``, 0 without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prof = written(docs.mapInArrow(lean(_profile(shingle_words)), "kind byte, id long, n long, cls long"), "profile")
    sets = prof.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "cls")
    classes = written(sets.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                             F.count("*").alias("class_size")), "classes")
    reps = classes.select("cls", "doc_id")

    total, squares = prof.where("kind = 2").agg(F.sum("n"), F.sum("cls")).first()
    sizes = {r["n"]: r["c"] for r in classes.where(F.col("n").between(4, 2 * LIGHT_MOST)).groupBy("n")
             .agg(F.count("*").alias("c")).collect()}  # at most 125 rows
    boundary = light_boundary(sizes, (squares or 0) / max(1, total or 0) - 1 if total else 0.0)

    hot = prof.where("kind = 1").groupBy("id").agg(F.sum("n").alias("c")) \
        .orderBy(F.desc("c"), "id").limit(HOT_MOST).toPandas()
    hot_keys = hot["id"].to_numpy(dtype=np.int64).view(np.uint64)
    o = np.argsort(hot_keys)
    hot_b = spark.sparkContext.broadcast((hot_keys[o], hot["c"].to_numpy(dtype=np.int64)[o]))

    lists = docs.select("text").mapInArrow(lean(_postings(shingle_words, boundary, hot_b)),
                                           "token long, cls long, n int, pos int") \
        .repartition("token").groupBy("token", "cls").agg(F.first("n").alias("n"), F.first("pos").alias("pos"))
    # An element can only be the first common one of a linked pair if what follows it in either set
    # is enough for the overlap, 4/9 of both sizes; the list's smallest size is the easiest partner.
    lists = lists.withColumns({"c": F.expr("count(*) over (partition by token)"),
                               "least": F.expr("min(n) over (partition by token)")}) \
        .where("c > 1 and 9 * (n - pos) >= 4 * (n + greatest(least, cast(ceil(0.8 * n) as int)))") \
        .withColumn("c", F.expr("count(*) over (partition by token)")).where("c > 1")
    lists = written(lists.select("token", "cls", "n", "pos"), "lists")
    collected(spark)
    # The class with most list entries is the likeliest to link with the others: the original of
    # edited copies shares more of its elements than any copy does.
    degree = lists.groupBy("cls").agg(F.count("*").alias("degree"))
    hubs = written(lists.join(degree, "cls").selectExpr(
        "token", "cls", "n", "pos", "max(struct(degree, cls, n, pos)) over (partition by token) hub"), "hubs")
    dropped(spark, lists)
    lists = hubs
    collected(spark)

    stars = lists.where(f"cls <> hub.cls and {_may_link('n', 'pos', 'hub.n', 'hub.pos')}") \
        .select(F.col("cls").alias("a"), F.col("hub.cls").alias("b")).distinct()
    links = _linked(stars, reps, docs, shingle_words)
    collected(spark)
    comp = written(components(links), "stars")

    at = lists.join(comp, lists.cls == comp.node, "left") \
        .select("token", "cls", "n", "pos", F.coalesce("component", "cls").alias("comp"), F.col("hub.cls").alias("hub"))
    at = at.withColumns({"c0": F.expr("min(comp) over (partition by token)"),
                         "c1": F.expr("max(comp) over (partition by token)")}).where("c0 <> c1")
    at = written(at.select("token", "cls", "n", "pos", "comp", "hub"), "mixed")
    x, y = at.alias("x"), at.alias("y")
    rest = x.join(y, F.expr("x.token = y.token and x.cls > y.cls and x.comp <> y.comp and x.cls <> x.hub "
                            f"and y.cls <> x.hub and {_may_link('x.n', 'x.pos', 'y.n', 'y.pos')}")) \
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
    more = _linked(rest, reps, docs, shingle_words)
    collected(spark)
    comp = written(components(links.union(more)), "comps")

    labelled = classes.join(comp, classes.cls == comp.node, "left") \
        .select("cls", "doc_id", "class_size", F.coalesce("component", "cls").alias("comp"))
    least = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "comp").select("cls", "class_size", "component_id")
    return sets.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), "cls")
