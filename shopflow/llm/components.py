"""Connected components of a link table by alternating large-star / small-star steps.

Every step keeps connectivity and never adds more rows than it reads; a hub only meets its own
minimum, which is pre-aggregated before the shuffle. The links of each round are written to the
shared folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.store import dropped, written

MAX_ROUNDS = 60  # far above the logarithmic number needed; reaching it is an error, not a cut-off


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v), u > v: hang each node's neighbours on the smallest of them."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    j = both.join(low, "u")
    if large:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .union(low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``a``, ``b``; order and repeats do not
    matter); ``component`` is the smallest node reachable. Rows with a null end or equal ends add
    nothing; an empty link table gives an empty result."""
    spark = edges.sparkSession
    cur = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "links")
    mark = None
    for _ in range(MAX_ROUNDS):
        new = written(_star(_star(cur, True), False), "links")
        row = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        dropped(spark, cur)
        cur, done, mark = new, mark == tuple(row), tuple(row)
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
