"""Seeded synthetic action log and dimensions (S11-S16), generated on executors.

Every random draw is a hash of (seed, row identity, purpose), so the same seed gives the same
rows whatever the partitioning, and a recomputed task gives the same rows again. One session
is generated per row of a seed frame (any table's key column), so the volume follows the data.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the reference generator: option weights and the city table.
PROFESSIONS = [("学生", 40), ("程序员", 30), ("经理", 20), ("老师", 10)]
GENDERS = [("男", 60), ("女", 40)]
PRODUCT_KINDS = [("自营", 70), ("第三方", 30)]
SEARCH_WORDS = [("手机", 30), ("笔记本", 70), ("内存", 70), ("i7", 70), ("苹果", 70), ("吃鸡", 70)]
ACTIONS = [("search", 20), ("click", 60), ("order", 6), ("pay", 4), ("quit", 10)]
CITIES = [(1, "北京", "华北"), (2, "上海", "华东"), (3, "深圳", "华南"), (4, "广州", "华南"),
          (5, "武汉", "华中"), (6, "南京", "华东"), (7, "天津", "华北"), (8, "成都", "西南"),
          (9, "哈尔滨", "东北"), (10, "大连", "东北"), (11, "沈阳", "东北"), (12, "西安", "西北"),
          (13, "长沙", "华中"), (14, "重庆", "西南"), (15, "济南", "华东"), (16, "石家庄", "华北"),
          (17, "银川", "西北"), (18, "杭州", "华东"), (19, "保定", "华北"), (20, "福州", "华南"),
          (21, "贵阳", "西南"), (22, "青岛", "华东"), (23, "苏州", "华东"), (24, "郑州", "华北"),
          (25, "无锡", "华东"), (26, "厦门", "华南")]


def _h(seed: int, *parts) -> Column:
    cols = [F.lit(int(seed))] + [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.xxhash64(*cols)


def uniform_int(lo: int, hi: int, seed: int, *parts) -> Column:
    """Integer uniform in [lo, hi]."""
    return (F.lit(lo) + F.pmod(_h(seed, *parts), F.lit(hi - lo + 1))).cast("long")


def uniform01(seed: int, *parts) -> Column:
    """Double uniform in (0, 1)."""
    return (F.pmod(_h(seed, *parts), F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def weighted(options: list[tuple], seed: int, *parts) -> Column:
    """Weighted choice among ``(value, weight)`` options (S13): a uniform bucket in [0, total)
    compared with the cumulative weights."""
    total = sum(w for _, w in options)
    bucket = F.pmod(_h(seed, *parts), F.lit(total))
    expr, acc = None, 0
    for value, w in options:
        acc += w
        expr = F.when(bucket < acc, F.lit(value)) if expr is None else expr.when(bucket < acc, F.lit(value))
    return expr


def random_id_list(lo: int, hi: int, amount: Column | int, seed: int, *parts, repeats: bool = False,
                   sep: str = ",") -> Column:
    """``amount`` ids from [lo, hi] joined by ``sep`` (S15); without repeats: a hash-shuffled
    range cut to ``amount``. Asking for more distinct ids than the range holds is an error
    (the reference loops for ever)."""
    if isinstance(amount, int):
        if not repeats and amount > hi - lo + 1:
            raise ValueError("amount exceeds the id range")
        amount = F.lit(amount)
    if repeats:
        picks = F.transform(F.sequence(F.lit(1), amount),
                            lambda i: F.lit(lo) + F.pmod(_h(seed, *parts, i), F.lit(hi - lo + 1)))
    else:
        keyed = F.transform(F.sequence(F.lit(lo), F.lit(hi)),
                            lambda x: F.struct(_h(seed, *parts, x).alias("k"), x.alias("v")))
        picks = F.transform(F.slice(F.array_sort(keyed), 1, amount), lambda s: s["v"])
    return F.array_join(F.transform(picks, lambda x: x.cast("string")), sep)


def gen_users(spark: SparkSession, n: int = 100, seed: int = 42) -> DataFrame:
    i = F.col("id")
    return spark.range(1, n + 1).select(
        i.alias("user_id"), F.concat(F.lit("user_"), i).alias("username"),
        F.concat(F.lit("name_"), i).alias("name"),
        uniform_int(10, 59, seed, "age", i).cast("int").alias("age"),
        weighted(PROFESSIONS, seed, "profession", i).alias("professional"),
        weighted(GENDERS, seed, "gender", i).alias("gender"))


def gen_products(spark: SparkSession, n: int = 100, seed: int = 42) -> DataFrame:
    i = F.col("id")
    return spark.range(1, n + 1).select(
        i.alias("product_id"), F.concat(F.lit("商品_"), i).alias("product_name"),
        weighted(PRODUCT_KINDS, seed, "kind", i).alias("extend_info"))


def gen_cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "city_id long, city_name string, area string")


def gen_actions(seeds: DataFrame, key: str, seed: int = 42, users: int = 100, products: int = 100,
                pages: int = 50, categories: int = 20, cities: int = 26,
                start: str = "2018-11-26", end: str = "2018-11-27", steps: int = 100000,
                bucket_sessions: int = 10000) -> DataFrame:
    """One session per row of ``seeds`` (its ``key`` column, a long), S11.

    Session length: each draw ends the session with the ``quit`` weight (10 of 100), so the
    number of actions is geometric; a zero-length session gives no rows. Action times follow
    one increasing clock over all sessions in key order: each step uniform in [0, 2*span/steps)
    ms (S16). The running sum is two-level - per bucket of ``bucket_sessions`` sessions (about
    9 rows each), then bucket offsets from the bucket totals (one row per bucket: 10^5 rows
    for 10^9 sessions) - so no window spans the whole data.
    """
    quit_w = dict(ACTIONS)["quit"]
    total_w = sum(w for _, w in ACTIONS)
    p_go = 1.0 - quit_w / total_w
    sid = F.col(key).cast("long")
    s = seeds.select(sid.alias("sid")).filter(F.col("sid").isNotNull())
    length = F.floor(F.log(uniform01(seed, "len", F.col("sid"))) / F.lit(math.log(p_go)))
    s = s.withColumn("len", length.cast("int")).filter(F.col("len") > 0)
    rows = s.select("sid", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("i"))

    span_ms = _day_ms(end) - _day_ms(start)
    max_step = max(1, 2 * span_ms // steps)
    rows = rows.withColumn("step", F.pmod(_h(seed, "step", F.col("sid"), F.col("i")), F.lit(max_step)))
    rows = rows.withColumn("bucket", F.floor(F.col("sid") / F.lit(bucket_sessions)))
    within = Window.partitionBy("bucket").orderBy("sid", "i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("local", F.sum("step").over(within))
    totals = rows.groupBy("bucket").agg(F.sum("step").alias("bt"))
    # One row per bucket of sessions: a small table, so one ordered pass over it is cheap.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("bucket", F.coalesce(F.sum("bt").over(before), F.lit(0)).alias("offset"))
    rows = rows.join(offsets, "bucket")
    clock = F.timestamp_millis(F.lit(_day_ms(start)) + F.col("offset") + F.col("local"))

    kind = weighted([a for a in ACTIONS if a[0] != "quit"], seed, "kind", F.col("sid"), F.col("i"))
    rows = rows.withColumn("ts", clock).withColumn("kind", kind)
    u = lambda name, lo, hi: uniform_int(lo, hi, seed, name, F.col("sid"), F.col("i"))
    n_ids = u("n_ids", 1, 5)
    k = F.col("kind")
    session_id = F.concat_ws("-", *[F.substring(F.md5(F.concat(F.lit(str(seed)), F.col("sid").cast("string"))), a, b)
                                    for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return rows.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        uniform_int(1, users, seed, "user", F.col("sid")).alias("user_id"),
        session_id.alias("session_id"),
        u("page", 1, pages).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(k == "search", weighted(SEARCH_WORDS, seed, "word", F.col("sid"), F.col("i")))
        .alias("search_keyword"),
        F.when(k == "click", u("ccat", 1, categories)).otherwise(F.lit(-1)).cast("long")
        .alias("click_category_id"),
        F.when(k == "click", u("cprod", 1, products)).otherwise(F.lit(-1)).cast("long")
        .alias("click_product_id"),
        F.when(k == "order", random_id_list(1, categories, n_ids, seed, "ocat", F.col("sid"), F.col("i")))
        .alias("order_category_ids"),
        # As in the reference generator, ordered / paid product ids are drawn from the category range.
        F.when(k == "order", random_id_list(1, categories, u("n_op", 1, 5), seed, "oprod", F.col("sid"), F.col("i")))
        .alias("order_product_ids"),
        F.when(k == "pay", random_id_list(1, categories, n_ids, seed, "pcat", F.col("sid"), F.col("i")))
        .alias("pay_category_ids"),
        F.when(k == "pay", random_id_list(1, categories, u("n_pp", 1, 5), seed, "pprod", F.col("sid"), F.col("i")))
        .alias("pay_product_ids"),
        u("city", 1, cities).alias("city_id"),
    )


def _day_ms(day: str) -> int:
    """UTC midnight of a ``yyyy-MM-dd`` day in epoch milliseconds."""
    d = dt.datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=dt.timezone.utc)
    return int(d.timestamp() * 1000)
