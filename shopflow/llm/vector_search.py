"""Nearest neighbours by shifted space-filling curves.

Each of several orderings projects the vectors to a few dimensions (a seeded rotation), shifts and
quantises them, and orders them by Hilbert index. Spark range-partitions every ordering by its key;
positions follow from the partition sizes, and equal runs of positions are blocks. A query looks into
the blocks around its own place in every ordering, so its neighbouring key windows merge; candidates
are reranked by cosine in double precision on the original vectors.

How many blocks to either side is measured, not set: for a bounded hash sample of queries the true
neighbours are found by comparing with all vectors, and the window is the smallest for which the
blocks hold ``recall`` of them. Data without structure therefore gets wide windows instead of wrong
results; clustered data narrow ones.

Equal vectors are one class that keeps its smallest ids (as many as a result can use), so a vector
repeated in a third of the rows is indexed once and its ties still come out exactly.

Defined cases: null, zero vectors, vectors of another length than most, or with null or non-finite
components take no part, as query or candidate. Ties go to the smaller id. Fewer candidates than
asked: all of them. Rows with null or repeated ids: null ids take no part, repeated rows count
once. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.store import written

ORDERINGS = 4
DIMS, BITS = 7, 9               # 63-bit keys
BLOCK = 2048
SAMPLE_QUERIES = 200
RECALL = 0.97
QUERY_STEP = 50


def rotation(dim: int, ordering: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Projection to DIMS dimensions and shift of one ordering."""
    rng = np.random.default_rng([seed, ordering])
    q, _ = np.linalg.qr(rng.standard_normal((dim, min(dim, DIMS))))
    return q, rng.random(q.shape[1])


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (one row each; coordinates below 2**bits), by exchanging and
    inverting low bits from the top bit down, then interleaving the Gray code."""
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for d in range(len(x)):
            on = (x[d] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[d]
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where(x[-1] & (1 << b), flip ^ ((1 << b) - 1), flip)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << 1) | (((x[d] ^ flip) >> b) & 1)
    return key


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(col), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _keys(dim: int, orderings: int):
    # Projections of unit vectors spread by about 1/sqrt(dim); 4 such widths to either side are kept apart.
    wide = 8.0 / np.sqrt(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = [rotation(dim, o) for o in range(orderings)]
        for b in batches:
            u = _unit(_matrix(b.column(1), dim))
            for o, (q, shift) in enumerate(turns):
                at = (u @ q / wide + 0.5 + (shift - 0.5) / 4) * (1 << BITS)
                key = hilbert_keys(np.clip(at, 0, (1 << BITS) - 1).astype(np.int64))
                yield pa.record_batch([pa.array(np.full(len(u), o, dtype=np.int32)), pa.array(key), b.column(0)],
                                      names=["o", "key", "cls"])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position of every row within its partition, per ordering (rows come sorted)."""
    seen: dict[int, int] = {}
    for b in batches:
        o = b.column(0).to_numpy()
        i = np.zeros(len(o), dtype=np.int64)
        for k in np.unique(o).tolist():
            m = o == k
            i[m] = seen.get(k, 0) + np.arange(m.sum())
            seen[k] = seen.get(k, 0) + int(m.sum())
        yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(i)], names=["o", "cls", "part", "i"])


def _positions(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """(o, cls, pos): place of every class in every ordering. The sorted rows are written with their
    partition, so the offsets fit them even if a task runs again."""
    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = keys.repartitionByRange(n, "o", "key", "cls").sortWithinPartitions("o", "key", "cls") \
        .select("o", "cls", F.spark_partition_id().cast("long").alias("part")) \
        .mapInArrow(_numbered, "o int, cls long, part long, i long")
    rows = written(rows, "order")
    counts = rows.groupBy("o", "part").agg(F.count("*").alias("n"))  # a few rows per partition
    offset = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("o").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.join(F.broadcast(offset.drop("n")), ["o", "part"]).select("o", "cls", (F.col("i") + F.col("before")).alias("pos"))


def _rank(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, low: np.ndarray, k: int):
    """Per query the k + 1 best classes: cosine, ties to the class with the smaller first id."""
    s = _unit(q) @ _unit(x).T
    for r in range(len(q)):
        if len(ids) > 4 * k + 4:  # all that reach the (k + 1)th best score, ties included
            least = np.partition(s[r], len(ids) - k - 1)[len(ids) - k - 1]
            c = np.flatnonzero(s[r] >= least - 1e-12)
        else:
            c = np.arange(len(ids))
        yield r, c[np.lexsort((low[c], -np.round(s[r][c], 10)))[:k + 1]], s[r]


def search(vectors: DataFrame, k: int = 5, query_step: int = QUERY_STEP, orderings: int = ORDERINGS,
           block: int = BLOCK, recall: float = RECALL, sample: int = SAMPLE_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose vec_id is divisible by ``query_step``, from a
    table (vec_id, embedding)."""
    spark = vectors.sparkSession
    good = "embedding is not null and vec_id is not null and size(embedding) > 0 " \
           "and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) " \
           "and exists(embedding, x -> x <> 0)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")) \
        .where(good)
    top = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if top is None:
        return empty
    dim = top["d"]
    rows = written(rows.where(F.size("embedding") == dim).select(
        "vec_id", F.xxhash64("embedding", F.hash("embedding")).alias("cls"), "embedding").distinct(), "vectors")
    ids = rows.select("cls", "vec_id").distinct()
    kept = written(ids.withColumn("n", F.row_number().over(Window.partitionBy("cls").orderBy("vec_id")))
                   .where(F.col("n") <= k + 1).select("cls", "vec_id"), "ids")
    classes = written(rows.groupBy("cls").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("low"),
                                              F.max((F.pmod("vec_id", F.lit(query_step)) == 0)).alias("is_query")), "classes")
    places = written(_positions(classes.select("cls", "embedding").mapInArrow(_keys(dim, orderings), "o int, key long, cls long"),
                                classes).withColumn("block", F.floor(F.col("pos") / block)), "places")
    blocks = (classes.count() + block - 1) // block
    reach = _reach(classes, places, dim, k, sample, recall, blocks)

    full = classes.join(places, "cls").select("o", "block", "cls", "low", "embedding", "is_query")
    asked = full.where("is_query").select(F.col("o").alias("to"), F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("block") - reach), F.least(F.lit(blocks - 1), F.col("block") + reach))).alias("at"),
        F.col("cls").alias("q"), F.col("embedding").alias("asked"))

    def rerank(key, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "cls": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids, low = x["cls"].to_numpy(), x["low"].to_numpy()
        out = [(np.full(len(c), q["q"].to_numpy()[r]), ids[c], s[c])
               for r, c, s in _rank(np.stack(q["asked"].to_list()), np.stack(x["embedding"].to_list()), q["q"].to_numpy(), ids, low, k)]
        return pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("q", "cls", "score"))})

    found = asked.groupBy("to", "at").cogroup(full.drop("is_query").groupBy("o", "block")) \
        .applyInPandas(rerank, "q long, cls long, score double")
    # One row per query and class; scores of one pair agree up to the order of summation.
    pairs = found.groupBy("q", "cls").agg(F.max("score").alias("near"))
    vec = classes.select("cls", "embedding")
    best = pairs.join(classes.select("cls", "low"), "cls") \
        .withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc(F.round("near", 10)), "low"))) \
        .where(F.col("n") <= 4 * (k + 1)).select("q", "cls")
    exact = best.join(vec.withColumnRenamed("embedding", "y"), "cls") \
        .join(vec.select(F.col("cls").alias("q"), F.col("embedding").alias("x")), "q") \
        .mapInArrow(_cosine(dim), "q long, cls long, score double")
    queries = ids.where(F.pmod("vec_id", F.lit(query_step)) == 0).select(F.col("cls").alias("q"), F.col("vec_id").alias("query_id"))
    return queries.join(exact, "q").join(kept, "cls").where("vec_id <> query_id") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cosine(dim: int):
    """(q, cls, y, x) -> cosine of x and y, in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = _matrix(b.column("x"), dim), _matrix(b.column("y"), dim)
            s = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            yield pa.record_batch([b.column("q"), b.column("cls"), pa.array(s)], names=["q", "cls", "score"])

    return run


def _reach(classes: DataFrame, places: DataFrame, dim: int, k: int, sample: int, recall: float, blocks: int) -> int:
    """Blocks to either side of a query's own that hold ``recall`` of the sample queries' neighbours."""
    spark = classes.sparkSession
    some = classes.where("is_query").orderBy(F.xxhash64("cls"), "cls").limit(sample).select("cls", "embedding").toPandas()
    if not len(some) or blocks <= 1:
        return 0
    q_b = spark.sparkContext.broadcast((some["cls"].to_numpy(), np.stack(some["embedding"].to_list())))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = q_b.value
        for b in batches:
            ids = b.column(0).to_numpy()
            for r, c, s in _rank(q, _matrix(b.column(1), dim), own, ids, ids, k):
                yield pa.record_batch([pa.array(np.full(len(c), own[r])), pa.array(ids[c]), pa.array(s[c])],
                                      names=["q", "cls", "score"])

    true = classes.select("cls", "embedding").mapInArrow(nearest, "q long, cls long, score double").where("q <> cls") \
        .withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))).where(F.col("n") <= k)
    a, b = places.alias("a"), places.alias("b")
    gap = F.broadcast(true).alias("t").join(a, F.expr("a.cls = t.q")).join(b, F.expr("b.cls = t.cls and b.o = a.o")) \
        .groupBy("t.q", "t.cls").agg(F.min(F.abs(F.col("a.block") - F.col("b.block"))).alias("gap"))
    gaps = sorted(r["gap"] for r in gap.collect())  # at most sample * k rows
    return int(gaps[min(len(gaps) - 1, int(np.ceil(recall * len(gaps))) - 1)]) if gaps else 0
