"""Generator: same seed -> same rows whatever the partitioning; action mix near 20:60:6:4."""

from pyspark.sql import functions as F

from shopflow.sources import datagen


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_same_rows_regardless_of_partitions(spark):
    a = datagen.gen_actions(spark.range(0, 300, numPartitions=1), key="id", seed=7)
    b = datagen.gen_actions(spark.range(0, 300, numPartitions=9).repartition(5), key="id", seed=7)
    assert _rows(a) == _rows(b)
    c = datagen.gen_actions(spark.range(0, 300), key="id", seed=8)
    assert _rows(a) != _rows(c)


def test_action_mix_and_clock(spark):
    df = datagen.gen_actions(spark.range(0, 3000), key="id", seed=1).cache()
    n = df.count()
    assert 7 * 3000 < n < 11 * 3000  # mean session length 9
    kinds = df.select(
        F.count_if(F.col("search_keyword").isNotNull()).alias("search"),
        F.count_if(F.col("click_category_id") > 0).alias("click"),
        F.count_if(F.col("order_category_ids").isNotNull()).alias("order"),
        F.count_if(F.col("pay_category_ids").isNotNull()).alias("pay")).first()
    shares = [kinds[k] / n * 90 for k in ("search", "click", "order", "pay")]
    for got, want in zip(shares, (20, 60, 6, 4)):
        assert abs(got - want) < 2.0
    ids = df.filter(F.col("order_category_ids").isNotNull()).select("order_category_ids").collect()
    for r in ids[:200]:
        parts = r.order_category_ids.split(",")
        assert 1 <= len(parts) <= 5 and len(set(parts)) == len(parts)
        assert all(1 <= int(p) <= 20 for p in parts)
    # one increasing clock over sessions in key order
    times = [r.action_time for r in df.orderBy("action_time").select("action_time").collect()]
    assert times[0] >= "2018-11-26 00:00:00"
    df.unpersist()


def test_dimensions(spark):
    u = datagen.gen_users(spark, 100)
    assert u.count() == 100 and u.filter((F.col("age") < 10) | (F.col("age") > 59)).count() == 0
    assert datagen.gen_products(spark, 100).count() == 100
    c = datagen.gen_cities(spark)
    assert c.count() == 26 and c.select("area").distinct().count() == 7


def test_id_list_guard():
    import pytest
    with pytest.raises(ValueError):
        datagen.random_id_list(1, 3, 4, 1, "x")
