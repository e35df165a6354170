"""Category action counts, the top categories and their most active sessions.

One action counts for one kind only: click if its click category is positive, else each id
of its order list, else each id of its pay list (D19). Lists are split on commas, trimmed,
and empty tokens dropped (D10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.exprs import csv_ids

KINDS = ("click", "order", "pay")


def category_actions(actions: DataFrame) -> DataFrame:
    """One row per (action, category, kind) (A4, C1, C18): an array by branch, then explode."""
    def tagged(ids, kind):
        return F.transform(ids, lambda x: F.struct(x.alias("category_id"), F.lit(kind).alias("kind")))

    click = F.array(F.struct(F.col("click_category_id").cast("string").alias("category_id"),
                             F.lit("click").alias("kind")))
    entries = (F.when(F.col("click_category_id") > 0, click)
               .when(F.col("order_category_ids").isNotNull(), tagged(csv_ids("order_category_ids"), "order"))
               .when(F.col("pay_category_ids").isNotNull(), tagged(csv_ids("pay_category_ids"), "pay")))
    return (actions.select(F.explode(entries).alias("e"))
            .select(F.col("e.category_id").alias("category_id"), F.col("e.kind").alias("kind")))


def category_action_counts(actions: DataFrame) -> DataFrame:
    """Count per (category, kind) (A4, A13): partial + final hash aggregate."""
    return category_actions(actions).groupBy("category_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def category_counts(actions: DataFrame) -> DataFrame:
    """One row per category with click / order / pay counts, 0 when missing (A5)."""
    k = F.col("kind")
    return category_actions(actions).groupBy("category_id").agg(
        *[F.count_if(k == kind).alias(f"{kind}_count") for kind in KINDS])


def category_top(counts: DataFrame, n: int = 10, ascending: bool = False) -> DataFrame:
    """Top ``n`` categories by clicks, then orders, then payments, then id.

    ``orderBy(...).limit(n)`` is planned as TakeOrderedAndProject: each task keeps its own n
    best rows and only those reach the final merge. ``ascending=True`` gives the bottom n.
    """
    order = [F.col(c).asc() if ascending else F.col(c).desc()
             for c in ("click_count", "order_count", "pay_count")]
    return counts.orderBy(*order, F.col("category_id").asc()).limit(n)


def category_session_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (category, session)."""
    return (actions.filter(F.col("click_category_id") > 0)
            .select(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
            .groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(actions: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """For each category of ``top``, its ``n`` sessions with most clicks.

    ``top`` is a ``limit``-ed frame (at most its n rows), so broadcasting it is safe; the clicks
    are cut to those categories before counting. Ties go to the smaller session id (D6).
    The literal ``rn <= n`` lets Spark keep only n rows per category per task before the
    shuffle (WindowGroupLimit), so a hot category does not gather all its sessions in one task.
    """
    keys = F.broadcast(top.select("category_id"))
    clicks = (actions.filter(F.col("click_category_id") > 0)
              .select(F.col("click_category_id").cast("string").alias("category_id"), "session_id")
              .join(keys, "category_id", "left_semi"))
    counted = clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id").asc())
    return (counted.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
            .withColumn("rn", F.col("rn").cast("long")))
