"""``groupby_city_count``: the city-share remark for SQL text (U1), an aggregate over raw clicks.

It stands beside other aggregates in one statement, one level of grouping, straight over the clicks::

    SELECT area, click_product_id, count(*) AS clickcount,
           groupby_city_count(approx_top_k(city_name, 65536, 1000000), count(*)) AS city_remark
    FROM area_clicks GROUP BY area, click_product_id

The counting is Spark's own mergeable item counter, so every task sends one counter per group, with an
entry per city, whatever the clicks: a group with a third of all rows costs a few entries. The counter is
exact while a group has fewer than 750,000 cities (it drops items only beyond that); the function checks
that its counts add up to the group's and fails rather than give a rough share. ``groupby_city_count``
itself words the counts and is plain SQL, as a SQL function cannot hold an aggregate, and a Python
aggregate could not stand beside ``count(*)`` and would take a whole group in one call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.operators.areas import OTHER_LABEL, area_clicks

MOST_CITIES, TRACKED = 65536, 1_000_000
CITY_COUNTS = f"approx_top_k(city_name, {MOST_CITIES}, {TRACKED})"


def register_city_remark(spark: SparkSession, name: str = "groupby_city_count", n: int = 2,
                         other_label: str = OTHER_LABEL) -> None:
    """Register the function for SQL text under ``name``: the same rule as ``areas.city_remark``. Its second
    argument, the group's number of rows, is optional; with it, counts that do not add up are an error."""
    label = other_label.replace("\\", "\\\\").replace("'", "\\'")
    # A list of (count, name), as collect_list(struct(c, city_name)) gives, is turned round first: there the second
    # field holds something else than a whole number.
    pairs = ("transform(if(exists(cities, x -> try_cast(x.count AS BIGINT) IS NULL),"
             " transform(cities, x -> named_struct('item', x.count, 'count', x.item)), cities),"
             " x -> named_struct('item', x.item, 'count', cast(x.count AS BIGINT)))")
    total = "aggregate(p, 0L, (t, x) -> t + x.count)"
    ordered = (f"array_sort(transform(p, x -> named_struct('neg', -floor(x.count / {total} * 1000D + 0.5D) / 10D,"
               " 'name', x.item)))")
    rest = f"floor(aggregate(slice(o, 1, {int(n)}), 100D, (t, x) -> t + x.neg) * 10D + 0.5D) / 10D"
    words = f"""array_join(flatten(transform(array({ordered}), o -> concat(
            transform(slice(o, 1, {int(n)}), x -> concat(x.name, ':', cast(0D - x.neg AS STRING), '%')),
            if(size(o) > {int(n)}, array(concat('{label}:', cast({rest} AS STRING), '%')),
               cast(array() AS ARRAY<STRING>))))), ',')"""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(cities ARRAY<STRUCT<item: STRING, count: STRING>>,
                                                    clicks BIGINT DEFAULT NULL)
        RETURNS STRING RETURN element_at(transform(array({pairs}), p -> if(clicks IS NOT NULL AND clicks <> {total},
            raise_error('{name}: a group has more cities than are counted exactly'), {words})), 1)""")


def area_city_remark_sql(spark: SparkSession, actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and remark per (area, product) through SQL text: one statement over the joined clicks."""
    register_city_remark(spark)
    return spark.sql(f"""
        SELECT area, click_product_id, count(*) AS clickcount,
               groupby_city_count({CITY_COUNTS}, count(*)) AS city_remark
        FROM {{clicks}} GROUP BY area, click_product_id""", clicks=area_clicks(actions, cities))


def area_top_products_sql(spark: SparkSession, actions: DataFrame, cities: DataFrame, products: DataFrame,
                          n: int = 3) -> DataFrame:
    """The whole area question (R6) as SQL text: count and remark, rank per area, name the products."""
    counted = area_city_remark_sql(spark, actions, cities)
    ranked = spark.sql("SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk FROM {counted}",
                       counted=counted)
    return spark.sql(f"""
        SELECT r.area, p.product_name, r.clickcount, CAST(r.rk AS BIGINT) AS rk, r.city_remark
        FROM {{ranked}} r JOIN {{products}} p ON p.product_id = r.click_product_id
        WHERE r.rk <= {int(n)}""", ranked=ranked, products=products)
