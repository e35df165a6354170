"""The corpus pipeline over ``documents``: quality, near duplicates, decontamination, mixing, sharding.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows its predecessor kept;
:func:`run` writes each result as Parquet in the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import decontaminate, jaccard_join, mixing, quality, sharding
from shopflow.llm.store import written

# Keys are sent to every executor while their table takes no more than this there.
BROADCAST_BYTES, KEY_BYTES = 64 << 20, 32
ORACLE_SQL = None  # a trained classifier and the thresholds it moves have no SQL form


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts 1 for."""
    cols = docs.columns
    rows = docs.select(F.struct(*_columns(docs)).alias("row"), "doc_id", "text")
    kept = quality.scored(rows, _table(spark, sf_dir, "labels")).where("predicted = 1")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in cols])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: the one with the smallest id (ids before nulls). Groups are
    made of rows, each known by a hash of its id and text, so rows that share an id but not a text, and rows
    without an id, are judged by their own texts. Texts without words are nobody's copy and all stay."""
    key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text"))
    keyed = docs.select(key.alias("doc_id"), "text")
    found = written(jaccard_join.grouped(keyed).where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id"),
                    "near")
    rows = found.groupBy("key").agg(F.first("component_id").alias("comp"), F.count("*").alias("n")) \
        .join(docs.select(key.alias("key"), "doc_id").distinct(), "key")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    rows = written(rows, "copies")
    first = rows.groupBy("comp").agg(least.alias("kept"))
    judged = rows.join(first, "comp").withColumn("why", F.when(F.col("key") != F.col("kept"), "copy").when(F.col("n") > 1, "repeat"))
    # Two rows may share a hash by accident; then a key is lost only if no row of it is to stay.
    out = written(judged.groupBy("key").agg(F.max(F.coalesce("why", F.lit("stays"))).alias("why"))
                  .where("why <> 'stays'").withColumnRenamed("key", "_key"), "losers")
    small = out.count() * KEY_BYTES <= BROADCAST_BYTES
    marked = docs.select(key.alias("_key"), F.struct(*_columns(docs)).alias("row")) \
        .join(F.broadcast(out) if small else out, "_key", "left")
    back = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    once, again = marked.where("why is null").select(*back), marked.where("why = 'repeat'")
    plain = [c for c, t in docs.dtypes if "map<" not in t and "variant" not in t]  # types that have a hash
    again = again.groupBy("_key").agg(F.min_by("row", F.xxhash64(*[F.col(f"row.`{c}`") for c in plain])).alias("row"))
    return once.unionByName(again.select(*back))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy or edited copy of a benchmark item (decided by text, so rows without
    an id are judged too)."""
    keyed = docs.select("text", F.xxhash64("text").alias("key"))
    bad = written(decontaminate.leaks(keyed, _table(spark, sf_dir, "benchmark"), key="key").select("key").distinct(),
                  "leaks")
    bad = bad.withColumnRenamed("key", "_key")
    if bad.count() * KEY_BYTES <= BROADCAST_BYTES:
        bad = F.broadcast(bad)
    return docs.join(bad, F.xxhash64(docs["text"]) == F.col("_key"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: left out, once, or repeated."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.sharded(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
