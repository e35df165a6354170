"""Hard negatives by angular triangle filtering.

Vectors are made integers (``floor(scale * x)``); the score of two is their integer inner product. A few
reference directions are chosen, and every row keeps its angles to them. For an anchor ``a``, a row ``x``
and a direction ``r`` the triangle inequality on the sphere gives ``|a_r - x_r| <= angle(a, x) <= a_r + x_r``
(and ``<= 2 pi - a_r - x_r``). Over all directions this is a cosine interval, and with the norms a score
interval, widened so that rounding can never lose a row. Rows are sorted by angle and cut into windows of
``WINDOW`` rows that keep the extremes of their angles and norms; only windows whose score interval meets
what an anchor still looks for are scored, exactly.

Everything runs in Spark: rows lie in cells (nearest direction, band of the angle to it), cells in pieces
of about ``PIECE`` rows, dealt by a hash, so no crowded cell is one task. Cells keep the same extremes
(at most ``REFERENCES * BANDS`` of them, whatever the table's size). An anchor first looks at the rows of
its own piece, which gives a lower bound of the scores it needs, then goes to the pieces of those cells
only whose interval meets that. A task holds one piece and streams the anchors sent to it.

Rules: rows with a null id, label or vector, or with a component that is null or, scaled, not finite take no part. Vectors
of different lengths are compared as if the shorter one ended in zeros; an all-zero or empty vector scores
0 with all. Repeated rows and ids are independent rows: a row is never its own positive, its copy is, and
every anchor row has its own answers. Ties go to the smaller id. Scores that no long can hold become the
nearest long. Other columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopflow.llm.store import written

REFERENCES, BANDS = 8, 16   # directions; bands of the angle to the nearest one
SAMPLE = 2048               # rows, by hash of the id, that the directions are chosen from
PIECE, WINDOW = 8192, 128   # rows a task holds, rows of a window
ANCHORS = 256               # anchors scored at a time
EXACT = 2.0 ** 53           # integers a double holds exactly
LEAST, MOST = -(1 << 63), (1 << 63) - 1
SLACK = 1e-6                # covers the error of stored angles, relative to the product of the norms

ROW = "cell int, piece int, kind int, rid long, vec_id long, label long, v array<double>, theta array<double>, " \
      "norm double, lo array<long>, hi array<long>, same boolean"
FOUND = "anchor long, slot int, score long, vec_id long, rid long"


def _matrix(col: pa.ListArray) -> np.ndarray:
    """A list column as a matrix, shorter rows padded with zeros."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    at = np.asarray(col.offsets, dtype=np.int64)
    flat = np.asarray(col.values, dtype=np.float64)
    sizes = np.diff(at)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    if len(sizes) and out.shape[1]:
        held = np.arange(out.shape[1]) < sizes[:, None]
        out[held] = flat[at[0]:at[-1]]
    return out


def _ragged(col: pa.ListArray) -> list[np.ndarray]:
    at = np.asarray(col.offsets, dtype=np.int64)
    return np.split(np.asarray(col.values)[at[0]:at[-1]], at[1:-1] - at[0]) if len(col) else []


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return m[:, :width] if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def directions(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """``n`` unit vectors out of a sample, each far from those before it (fewer if rows run out)."""
    most = np.abs(sample).max(axis=1, initial=0)
    unit = sample[most > 0] / most[most > 0, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        k = int(np.argmin(near))
        if near[k] > 1 - 1e-9:
            break
        chosen.append(k)
        near = np.maximum(near, unit @ unit[k])
    return unit[chosen]


def angles(v: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of rows to the directions (a right angle for zero rows) and their norms."""
    most = np.abs(v).max(axis=1, initial=0)
    small = v / np.where(most > 0, most, 1)[:, None]  # squares of large components would overflow
    norm = np.linalg.norm(small, axis=1)
    width = max(v.shape[1], refs.shape[1])
    cos = _fit(small, width) @ _fit(refs, width).T / np.where(norm > 0, norm, 1)[:, None]
    with np.errstate(over="ignore"):
        return np.arccos(np.clip(cos, -1, 1)), norm * most


def interval(theta: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray,
             most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds (anchors x windows): ``theta`` and ``norm`` of anchors; extremes of the windows' angles
    (``low``, ``high``) and norms (``least``, ``most``)."""
    near = np.zeros((len(theta), len(low)))
    far = np.full((len(theta), len(low)), np.pi)
    for r in range(theta.shape[1]):
        t = theta[:, r, None]
        near = np.maximum(near, np.maximum(t - high[:, r], low[:, r] - t))
        far = np.minimum(far, np.minimum(t + high[:, r], 2 * np.pi - t - low[:, r]))
    top, bottom = np.cos(near), np.cos(np.maximum(far, near))
    with np.errstate(over="ignore", invalid="ignore"):
        slack = SLACK * norm[:, None] * most + 1
        top = np.ceil(norm[:, None] * top * np.where(top > 0, most, least) + slack)
        bottom = np.floor(norm[:, None] * bottom * np.where(bottom > 0, least, most) - slack)
    return (np.clip(np.nan_to_num(bottom, nan=-np.inf), LEAST, MOST),
            np.clip(np.nan_to_num(top, nan=np.inf, posinf=np.inf), LEAST, MOST))


def _prepare(refs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_matrix(batch.column("v").slice(k, 1024)) for k in range(0, batch.num_rows, 1024)]
            got = [angles(m, refs) for m in parts]
            theta = np.concatenate([t for t, _ in got]) if got else np.zeros((0, len(refs)))
            norm = np.concatenate([x for _, x in got]) if got else np.zeros(0)
            cell = np.zeros(len(norm), dtype=np.int32)
            if len(refs):
                near = theta.argmin(axis=1)
                band = np.minimum(theta[np.arange(len(near)), near] / np.pi * 2 * BANDS, BANDS - 1)
                cell = (near * BANDS + band.astype(np.int64)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(norm) + 1, dtype=np.int32) * len(refs)),
                                             pa.array(theta.ravel()))
            yield pa.record_batch([*batch.columns, lists, pa.array(norm), pa.array(cell)],
                                  names=[*batch.schema.names, "theta", "norm", "cell"])

    return run


def _route(cells: pd.DataFrame):
    """The cells in which an anchor can still find what it looks for."""
    width = len(cells["low"].iloc[0]) if len(cells) else 0
    low, high = (np.array(cells[c].tolist(), dtype=float).reshape(len(cells), width) for c in ("low", "high"))
    least, most = cells["least"].to_numpy(), cells["most"].to_numpy()
    number = cells["cell"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bottom, top = interval(_fit(_matrix(batch.column("theta")), low.shape[1]),
                                   batch.column("norm").to_numpy(), low, high, least, most)
            wanted = [np.zeros(0, np.int32)] * batch.num_rows
            for k, (lo, hi) in enumerate(zip(_ragged(batch.column("lo")), _ragged(batch.column("hi")))):
                meets = (top[k][:, None] >= lo) & (bottom[k][:, None] <= hi)
                wanted[k] = number[meets.any(axis=1)].astype(np.int32)
            to = np.cumsum([0] + [len(w) for w in wanted]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(to), pa.array(np.concatenate([*wanted, np.zeros(0, np.int32)])))
            yield pa.record_batch([*batch.columns, lists], names=[*batch.schema.names, "cells"])

    return run


class _Piece:
    """The rows of one piece, cut into windows."""

    def __init__(self, batches: list[pa.RecordBatch], window: int) -> None:
        t = pa.Table.from_batches(batches)
        theta, norm = _matrix(t["theta"]), t["norm"].to_numpy()
        v = [x for b in batches for x in _ragged(b.column("v"))]
        size = np.array([len(x) for x in v])
        first = theta[:, theta.sum(axis=0).argmin()] if theta.shape[1] else norm
        order = np.lexsort((norm, first, size))
        rid, vec, label = (t[c].to_numpy()[order] for c in ("rid", "vec_id", "label"))
        theta, norm, size = theta[order], norm[order], size[order]
        cuts, at = [], 0
        while at < len(order):  # a window holds rows of one length
            to = min(at + window, int(np.searchsorted(size, size[at], "right")))
            cuts.append(slice(at, to))
            at = to
        self.windows = [(rid[c], vec[c], label[c], np.array([v[k] for k in order[c]]).reshape(c.stop - c.start, int(size[c.start])))
                        for c in cuts]
        ends = lambda f, x: np.array([f(x[c], axis=0) for c in cuts])
        self.low, self.high = ends(np.min, theta), ends(np.max, theta)
        self.least, self.most = ends(np.min, norm), ends(np.max, norm)

    def find(self, part: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
        """The best ``k`` rows of this piece in each of the score ranges of each anchor."""
        theta, norm = _fit(_matrix(part.column("theta")), self.low.shape[1]), part.column("norm").to_numpy()
        lo, hi = _ragged(part.column("lo")), _ragged(part.column("hi"))
        slots = max(map(len, lo), default=0)
        low = np.full((len(lo), slots), MOST, dtype=np.int64)
        high = np.full((len(lo), slots), LEAST, dtype=np.int64)  # a range that nothing meets
        for i, (a, b) in enumerate(zip(lo, hi)):
            low[i, :len(a)], high[i, :len(b)] = a, b
        rid, label, same = (part.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "label", "same"))
        v = _matrix(part.column("v"))
        bottom, top = interval(theta, norm, self.low, self.high, self.least, self.most)
        meets = ((top[:, :, None] >= low[:, None, :]) & (bottom[:, :, None] <= high[:, None, :])).any(axis=2)
        found: list[np.ndarray] = []
        held = 0
        for w in np.flatnonzero(meets.any(axis=0)):
            who = np.flatnonzero(meets[:, w])
            rids, vecs, labels, x = self.windows[w]
            ok = ((labels == label[who, None]) == same[who, None]) & (rids != rid[who, None])
            if not ok.any():
                continue
            score = _scores(_fit(v[who], x.shape[1]), x, norm[who].max() * self.most[w])
            for s in range(slots):
                a, b = np.nonzero(ok & (score >= low[who, s, None]) & (score <= high[who, s, None]))
                if len(a):
                    found.append(np.stack([rid[who[a]], np.full(len(a), s), score[a, b], vecs[b], rids[b]]))
                    held += len(a)
            if held > 1 << 19:
                found = [_best(found, k)]
                held = found[0].shape[1]
        if found:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(_best(found, k), (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                                  names=["anchor", "slot", "score", "vec_id", "rid"])


def _scores(a: np.ndarray, x: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of integer rows, as longs."""
    if most < EXACT:  # no partial sum can leave what doubles hold exactly
        return (a @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(c) for c in r] for r in m.tolist()], dtype=object).reshape(m.shape)
    return np.array([[min(max(s, LEAST), MOST) for s in r] for r in (whole(a) @ whole(x).T).tolist()],
                    dtype=np.int64).reshape(len(a), len(x))


def _best(found: list[np.ndarray], k: int) -> np.ndarray:
    """The first ``k`` of each (anchor, slot): larger scores, then smaller ids."""
    f = np.concatenate(found, axis=1)
    f = f[:, np.lexsort((f[4], f[3], ~f[2], f[1], f[0]))]
    start = np.r_[True, (f[:2, 1:] != f[:2, :-1]).any(axis=0)]
    begin = np.maximum.accumulate(np.where(start, np.arange(len(start)), 0))
    return f[:, np.arange(len(start)) - begin < k]


def _scan(k: int, window: int):
    """Over rows sorted by (cell, piece, kind): a piece's rows first, then the anchors sent to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, piece = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "piece", "kind")])
            cuts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
                key, kind = tuple(keys[:2, a]), keys[2, a]
                if key != now:
                    now, rows, piece = key, [], None
                if kind == 0:
                    rows.append(batch.slice(a, b - a))
                elif rows or piece:
                    piece = piece or _Piece(rows, window)
                    rows = []
                    for c in range(a, b, ANCHORS):
                        yield from piece.find(batch.slice(c, min(ANCHORS, b - c)), k)

    return run


class Miner:
    """The rows with their angles, cells and pieces, written once."""

    def __init__(self, rows: DataFrame, scale: float, piece: int = PIECE, window: int = WINDOW) -> None:
        self.spark, self.window = rows.sparkSession, window
        scaled = lambda x: F.lit(float(scale)) * x.cast("double")
        whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < F.lit(float("inf"))))
        # floor() gives a long; from 2**53 on a double is a whole number already.
        v = F.transform("embedding", lambda x: F.when(F.abs(scaled(x)) < F.lit(EXACT), F.floor(
            F.when(F.abs(scaled(x)) < F.lit(EXACT), scaled(x))).cast("double")).otherwise(scaled(x)))
        rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(whole)
        rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           v.alias("v"))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"].tolist()
        width = max(map(len, sample), default=0)
        refs = directions(np.array([np.pad(np.asarray(x, float), (0, width - len(x))) for x in sample]).reshape(len(sample), width))
        made = rows.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
            _prepare(refs), "vec_id long, label long, v array<double>, rid long, theta array<double>, norm double, cell int")
        self.table = written(made, "angles")
        edge = lambda f, name: F.array(*[f(F.col("theta")[r]) for r in range(len(refs))]).cast("array<double>").alias(name)
        self.cells = self.table.groupBy("cell").agg(  # at most REFERENCES * BANDS rows
            edge(F.min, "low"), edge(F.max, "high"), F.min("norm").alias("least"), F.max("norm").alias("most"),
            (F.floor((F.count("*") - 1) / piece) + 1).alias("pieces")).toPandas()
        pieces = F.create_map(*[F.lit(x) for c, p in zip(self.cells["cell"], self.cells["pieces"]) for x in (int(c), int(p))]) \
            if len(self.cells) else F.create_map(F.lit(0), F.lit(1))
        self.pieces = lambda cell: F.element_at(pieces, cell)
        own = F.pmod(F.xxhash64("rid"), self.pieces(F.col("cell"))).cast("int")
        self.rows = self.table.withColumn("piece", own)

    def search(self, wants: DataFrame, k: int, home: bool = False) -> DataFrame:
        """The first ``k`` rows in each score range [lo, hi] of each row of ``wants`` (rows of the table with
        ``lo``, ``hi`` lists and ``same``: rows of the own label or of others). ``home``: in its own piece only."""
        if not home:
            routed = wants.drop("cell", "piece").mapInArrow(_route(self.cells), "rid long, vec_id long, label long, v array<double>, "
                                                            "theta array<double>, norm double, lo array<long>, hi array<long>, "
                                                            "same boolean, cells array<int>")
            wants = routed.withColumn("cell", F.explode("cells")).drop("cells") \
                .withColumn("piece", F.explode(F.sequence(F.lit(0), self.pieces(F.col("cell")).cast("int") - 1)))
        names = [c.split()[0] for c in ROW.split(", ")]
        none = F.lit(None)
        both = self.rows.select(*names[:2], F.lit(0).alias("kind"), *names[3:9], none.cast("array<long>").alias("lo"),
                                none.cast("array<long>").alias("hi"), none.cast("boolean").alias("same")) \
            .unionByName(wants.withColumn("kind", F.lit(1)).select(*names))
        found = both.repartition("cell", "piece").sortWithinPartitions("cell", "piece", "kind") \
            .mapInArrow(_scan(k, self.window), FOUND)
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "rid")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: str, scale: float = 256, positives: int = 5, negatives: int = 5,
         near: tuple[int, int] = (80, 100), piece: int = PIECE, window: int = WINDOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows of ``rows``
    (vec_id, label, embedding) that the SQL condition ``anchors`` names: for each of their first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels that score from
    ``near[0] / near[1]`` of the positive's score up to it."""
    m = Miner(rows, scale, piece, window)
    base = m.rows.where(anchors)
    at = ["rid", "vec_id", "label", "v", "theta", "norm"]

    def wants(extra: DataFrame | None, lo, hi, same: bool) -> DataFrame:
        joined = base if extra is None else base.join(extra, base["rid"] == extra["anchor"], "left" if same else "inner")
        return joined.select("cell", "piece", *at, lo.cast("array<long>").alias("lo"), hi.cast("array<long>").alias("hi"),
                             F.lit(same).alias("same"))

    # A row that is the k-th best of some rows is a lower bound of the k-th best of all.
    seed = m.search(wants(None, F.array(F.lit(LEAST)), F.array(F.lit(MOST)), True), positives, home=True)
    seed = seed.where(F.col("rank") == positives).select("anchor", F.col("score").alias("least"))
    same = m.search(wants(seed, F.array(F.coalesce("least", F.lit(LEAST))), F.array(F.lit(MOST)), True), positives)
    same = written(same.select("anchor", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"),
                               F.col("score").alias("positive_score")), "positives")

    # near[0] * positive <= near[1] * negative; a negative positive score leaves nothing.
    least = F.expr(f"cast((cast(positive_score as decimal(38,0)) * {near[0]} + {near[1] - 1}) div {near[1]} as long)")
    ranges = same.where("positive_score >= 0").withColumn("low", least)
    lists = lambda r: r.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "positive_score")))
                                              .alias("r")) \
        .select("anchor", F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.try_element_at(F.filter(
            "r", lambda s: s["slot"] == i), F.lit(1))).alias("r"))  # at most `positives` entries
    lo = F.transform("r", lambda s: F.coalesce(s["low"], F.lit(MOST)))
    hi = F.transform("r", lambda s: F.coalesce(s["positive_score"], F.lit(LEAST)))
    seed = m.search(wants(lists(ranges), lo, hi, False), negatives, home=True)
    seed = seed.where(F.col("rank") == negatives).select("anchor", "slot", F.col("score").alias("least"))
    ranges = ranges.join(seed, ["anchor", "slot"], "left").withColumn("low", F.greatest("low", "least"))
    other = m.search(wants(lists(ranges), lo, hi, False), negatives)
    names = base.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return other.join(same, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
