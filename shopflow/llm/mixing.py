"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Each source gets a target number of words. Every document counts ``floor(target / source size)``
times; for the remainder, the documents whose hash lies below the source's threshold count once
more. Thresholds come from histograms: words per (source, top 12 hash bits), a running sum over at
most 4096 buckets finds the bucket that the budget ends in, and only that bucket is split by the next
12 bits, until it holds one hash. Nothing is sorted, and a larger budget always takes a superset.

Targets: weights 1, 2, 3 repeat over the sources in code point order (null last); they share ``share``
percent of all words by weight. No target passes ``cap`` times its source's words; what is over goes
to the others by weight until none is above (solved at once by ordering sources by cap over weight).

Defined cases: null text has size 0; a null source is a source of its own. Documents with equal hash
(repeated rows) are taken or left together. Sources without words take nothing. An empty table gives
an empty result. Extra columns stay in :func:`mixed`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.store import written

WEIGHTS = (1, 2, 3)
CAP = 3
BITS, LEVELS = 12, 5
BROADCAST_SOURCES = 1_000_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash60(*cols: Column) -> Column:
    """A non-negative 60-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 4)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP,
                   share: float = 100.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size). The windows see one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) \
        .withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                      (F.col("i") % len(weights) + 1).cast("int"))) \
        .withColumn("most", F.lit(float(cap)) * F.col("source_size")) \
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * (share / 100.0))
    order = Window.orderBy(F.col("most") / F.col("w"), "i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = ranked.withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                              / F.sum("w").over(after)) \
        .withColumn("free", F.col("most") > F.col("level") * F.col("w"))
    level = level.withColumn("rate", F.max(F.when(F.col("free"), F.col("level"))).over(Window.partitionBy()))
    return level.select("source", "source_size",
                        F.when(F.col("free"), F.least("most", F.col("rate") * F.col("w"))).otherwise(F.col("most"))
                        .alias("target"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def thresholds(base: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, below, shift): how often every document counts, and the
    hash prefix below which it counts once more."""
    state = written(targets.withColumns({
        "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        "prefix": F.lit(0).cast("long"), "taken": F.lit(0).cast("long")})
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    by = Window.partitionBy("source", "source_size")
    for level in range(1, LEVELS + 1):
        shift = (LEVELS - level) * BITS
        s = _small(state).alias("s")
        at = base.alias("b").join(s, F.expr(f"b.source <=> s.source and shiftrightunsigned(b.h, {shift + BITS}) = s.prefix"))
        hist = at.groupBy(F.col("s.source").alias("source"), F.shiftrightunsigned("b.h", shift).alias("bucket")) \
            .agg(F.sum("b.size").alias("words"), F.min("b.h").alias("h0"), F.max("b.h").alias("h1"))
        j = hist.alias("x").join(_small(state).alias("s"), F.expr("x.source <=> s.source")) \
            .select("s.source", "source_size", "target", "whole", "rest", "taken", "bucket", "x.words", "h0", "h1")
        run = j.withColumn("upto", F.col("taken") + F.sum("words").over(
            by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
        # The bucket in which the budget ends: the first that reaches it, or else the last.
        cut = run.withColumn("reach", F.min(F.when(F.col("upto") >= F.col("rest"), F.col("bucket"))).over(by)) \
            .withColumn("at", F.coalesce("reach", F.max("bucket").over(by))).where("bucket = at")
        state = written(cut.select("source", "source_size", "target", "whole", "rest", F.col("bucket").alias("prefix"),
                                   (F.col("upto") - F.col("words")).alias("taken"), "words",
                                   (F.col("h0") < F.col("h1")).alias("many")), f"cut{level}")
        if not state.where("many and rest > 0").limit(1).count():
            break
    over = F.col("taken") + F.col("words") - F.col("rest")
    last = (F.col("rest") > 0) & (over < F.col("rest") - F.col("taken"))
    return state.select("source", "source_size", "target", "whole",
                        F.when(F.col("rest") > 0, F.col("prefix") + last.cast("long")).otherwise(0).alias("below"),
                        F.lit(shift).alias("shift"))


def _with_copies(rows: DataFrame, limits: DataFrame, source: str, h: str) -> DataFrame:
    r, t = rows.alias("r"), _small(limits).alias("t")
    return r.join(t, F.expr(f"r.{source} <=> t.source")).withColumn(
        "_copies", F.expr(f"t.whole + cast(shiftrightunsigned(r.{h}, t.shift) < t.below as long)"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per row of ``docs`` (doc_id, text,
    source)."""
    base = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                               hash60(F.col("doc_id"), F.col("text")).alias("h")), "sizes")
    limits = thresholds(base, source_targets(base, weights, cap))
    return _with_copies(base, limits, "source", "h").select(
        "r.doc_id", "r.source", "r.size", "t.source_size", "t.target", F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("r.size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once or several times; all columns."""
    cols = docs.columns
    base = written(docs.select("source", n_words(F.col("text")).alias("size"),
                               hash60(F.col("doc_id"), F.col("text")).alias("h")), "sizes")
    limits = thresholds(base, source_targets(base, weights, cap))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("source").alias("_source"),
                       hash60(F.col("doc_id"), F.col("text")).alias("_h"))
    got = _with_copies(rows, limits, "_source", "_h").where("_copies > 0") \
        .select("row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_n"))
    return got.select(*[F.col(f"row.`{c}`").alias(c) for c in cols])
