"""Per-area product clicks, city-share remarks and the top products per area.

Plan shape: clicks -> join cities -> partial/final count per (area, product, city) -> regroup
per (area, product) with a list bounded by the number of cities -> rank per area (pre-shuffle
WindowGroupLimit) -> join products. No UDF, no list longer than the city count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.exprs import half_up, pct_label, percent

# Fixed value: the label of the remainder share, the reference's literal word for "other".
OTHER_LABEL = "其他"


def area_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Positive product clicks with their city and area.

    The city dimension is joined without a hint: Spark broadcasts it when its size estimate is
    under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time), else shuffles.
    """
    clicks = actions.filter(F.col("click_product_id") > 0).select("click_product_id", "city_id")
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id")


def area_product_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product)."""
    return (area_clicks(actions, cities)
            .groupBy("area", "click_product_id")
            .agg(F.count(F.lit(1)).alias("clickcount")))


def city_remark(cities_col, total_col, n: int = 2, other_label: str = OTHER_LABEL):
    """Remark from ``array<struct(c, city_name)>``: top ``n`` city shares, plus the rest.

    Share = round_half_up(c / total * 1000) / 10. Order: share desc, then name asc. When there are
    more than ``n`` cities an ``other`` share = 100 - top shares (subtracted in list order),
    rounded to one decimal, is appended.
    """
    rated = F.transform(F.col(cities_col) if isinstance(cities_col, str) else cities_col,
                        lambda x: F.struct(
                            (-percent(x["c"], F.col(total_col), 1)).alias("neg_rate"),
                            x["city_name"].alias("name")))
    ordered = F.array_sort(rated)
    top = F.slice(ordered, 1, n)
    labels = F.transform(top, lambda x: pct_label(x["name"], -x["neg_rate"]))
    rest = F.aggregate(top, F.lit(100.0), lambda acc, x: acc + x["neg_rate"])
    other = F.when(F.size(ordered) > n, F.array(pct_label(F.lit(other_label), half_up(rest, 1))))
    return F.array_join(F.concat(labels, F.coalesce(other, F.array().cast("array<string>"))), ",")


def area_cities(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Per (area, product): click count and the unsorted list of its cities with their counts (A10).

    Counted per city first (partial aggregation before the shuffle), so the collected list per
    (area, product) holds at most one entry per city, whatever the click volume.
    """
    per_city = (area_clicks(actions, cities)
                .groupBy("area", "click_product_id", "city_name")
                .agg(F.count(F.lit(1)).alias("c")))
    return (per_city.groupBy("area", "click_product_id")
            .agg(F.sum("c").alias("clickcount"),
                 F.collect_list(F.struct("c", "city_name")).alias("cities")))


def area_city_remark(actions: DataFrame, cities: DataFrame, n: int = 2,
                     other_label: str = OTHER_LABEL) -> DataFrame:
    """Per (area, product): click count and the city-share remark (A10, L2)."""
    grouped = area_cities(actions, cities)
    return grouped.select("area", "click_product_id", "clickcount",
                          city_remark("cities", "clickcount", n, other_label).alias("city_remark"))


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame, n: int = 3,
                      other_label: str = OTHER_LABEL) -> DataFrame:
    """Top ``n`` products per area by clicks, ties kept (``rank``), then named.

    The rank is computed before the product join, as in the reference: a product missing from
    ``products`` uses up its rank and then drops out. City lists are sorted and worded only for
    the products that stay.
    """
    counted = area_cities(actions, cities)
    w = Window.partitionBy("area").orderBy(F.col("clickcount").desc())
    ranked = counted.withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= n)
    named = ranked.join(products.select(F.col("product_id").alias("click_product_id"), "product_name"),
                        "click_product_id")
    return named.select("area", "product_name", "clickcount", F.col("rk").cast("long").alias("rk"),
                        city_remark("cities", "clickcount", other_label=other_label).alias("city_remark"))
