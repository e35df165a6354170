"""Domain views over the generic test tables (FIXTURES.md section 2).

``events`` becomes the action log and the ad-click lines, ``customer`` the users, ``part`` the
products and ``nation`` x ``region`` the cities. Every view is derived column by column, so the
DuckDB oracle builds the same rows with the same SQL expressions (see ``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources.tables import read_table


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def events(spark: SparkSession, base: str) -> DataFrame:
    """The fact table."""
    return read_table(spark, "events", base)


def user_visit_action(spark: SparkSession, base: str) -> DataFrame:
    """13 action columns plus ``event_id`` (a tie-break for actions of the same second)."""
    ev = events(spark, base).select("event_id", "ts", "user_id", "event_type", _k().alias("k"))
    et = F.col("event_type")
    k = F.col("k")
    s = lambda c: c.cast("string")
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("user_id").cast("long").alias("user_id"),
        F.concat(s(F.col("user_id")), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        (k % 7 + 1).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(et == "view", F.concat(F.lit("kw"), s(k % 6))).alias("search_keyword"),
        F.when(et == "click", k % 20 + 1).otherwise(F.lit(-1)).cast("long").alias("click_category_id"),
        F.when(et == "click", F.col("event_id") % 100 + 1).otherwise(F.lit(-1)).cast("long")
        .alias("click_product_id"),
        F.when(et == "purchase", F.concat(s(k % 20 + 1), F.lit(","), s((k + 7) % 20 + 1)))
        .alias("order_category_ids"),
        F.when(et == "purchase", F.concat(s(k % 100 + 1), F.lit(","), s((k + 13) % 100 + 1)))
        .alias("order_product_ids"),
        F.when(et == "signup", s(k % 20 + 1)).alias("pay_category_ids"),
        F.when(et == "signup", s(k % 100 + 1)).alias("pay_product_ids"),
        (F.col("user_id") % 25).cast("long").alias("city_id"),
        F.col("event_id"),
    )


def user_info(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, "customer", base)
    key = F.col("c_custkey")
    return c.select(
        key.cast("long").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + key % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(key % 5 < 3, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
    )


def product_info(spark: SparkSession, base: str) -> DataFrame:
    p = read_table(spark, "part", base)
    return p.select(F.col("p_partkey").cast("long").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("extend_info"))


def city_info(spark: SparkSession, base: str) -> DataFrame:
    """Nations as cities, regions as areas. ``nation`` / ``region`` are fixed 25 / 5 row tables."""
    n = read_table(spark, "nation", base)
    r = read_table(spark, "region", base)
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("n_nationkey").cast("long").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("area")))


def ads_lines(spark: SparkSession, base: str, events_df: DataFrame | None = None) -> DataFrame:
    """Ad-click lines ``epoch_ms area city user_id ads_id`` built from every event.

    Returns ``value`` (the line) and ``seq`` (the event id, standing in for a stream offset).
    Blanks in region names become ``-`` so the line stays blank-separated. The city table is
    joined without a hint: Spark broadcasts it by its size.
    """
    ev = events_df if events_df is not None else events(spark, base)
    cities = city_info(spark, base)
    ev = ev.select("event_id", "ts", "user_id", _k().alias("k"),
                   (F.col("user_id") % 25).cast("long").alias("city_id"))
    j = ev.join(cities, "city_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    line = F.concat_ws(" ", millis.cast("string"), F.regexp_replace("area", " ", "-"),
                       F.col("city_name"), F.col("user_id").cast("string"),
                       (F.col("k") % 5 + 1).cast("string"))
    return j.select(line.alias("value"), F.col("event_id").alias("seq"))
