"""``groupby_city_count`` as an aggregate in SQL text."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopflow.functions.city_remark import CITY_COUNTS, register_city_remark
from shopflow.operators import areas


def remarks(spark, clicks, counts=CITY_COUNTS):
    register_city_remark(spark)
    return spark.sql(f"SELECT area, click_product_id, count(*) AS clickcount, sum(w) AS w, "
                     f"groupby_city_count({counts}, count(*)) AS city_remark "
                     "FROM {clicks} GROUP BY area, click_product_id", clicks=clicks)


def built_in(clicks):
    per = clicks.groupBy("area", "click_product_id", "city_name").agg(F.count("*").alias("c"))
    g = per.groupBy("area", "click_product_id").agg(F.sum("c").alias("n"), F.collect_list(F.struct("c", "city_name")).alias("l"))
    return {(r.area, r.click_product_id): (r.n, r.r) for r in
            g.select("area", "click_product_id", "n", areas.city_remark("l", "n").alias("r")).collect()}


def test_stands_beside_other_aggregates_over_a_group_larger_than_a_batch(spark):
    # One (area, product) holds nine tenths of 60,000 clicks in 5,000 cities; ties in most shares.
    clicks = spark.range(60_000).repartition(8).selectExpr(
        "if(id % 10 < 9, 'hot', concat('a', id % 4)) area", "if(id % 10 < 9, 1L, id % 7) click_product_id",
        "concat('city ', pmod(hash(id), 5000)) city_name", "1 w")
    got = {(r.area, r.click_product_id): (r.clickcount, r.city_remark) for r in remarks(spark, clicks).collect()}
    assert got == built_in(clicks)
    assert got["hot", 1][0] == 54_000


def test_plan_counts_before_the_shuffle_and_stays_in_the_jvm(spark):
    clicks = spark.range(1000).selectExpr("id % 3 area", "id % 5 click_product_id", "concat('c', id % 9) city_name", "1 w")
    plan = remarks(spark, clicks)._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k" in plan and "Python" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_more_cities_than_counted_is_an_error_not_a_rough_share(spark):
    clicks = spark.range(400).selectExpr("1 area", "1L click_product_id", "concat('c', id) city_name", "1 w")
    with pytest.raises(PySparkException, match="more cities"):
        remarks(spark, clicks, "approx_top_k(city_name, 8, 16)").collect()


def test_second_argument_is_optional(spark):
    register_city_remark(spark)
    assert spark.sql(f"SELECT groupby_city_count({CITY_COUNTS}) r FROM VALUES ('b'), ('a'), ('b'), ('c') AS t(city_name)") \
        .first().r == "b:50.0%,a:25.0%,其他:25.0%"
