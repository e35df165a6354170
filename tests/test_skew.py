"""Hot keys: one session holds a third of all rows. The chunked two-level plans must give exactly
what a brute-force single sort gives (pandas on a small fixture)."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopflow.operators import ads, funnel, sessions

SCHEMA = ("date string, user_id long, session_id string, page_id long, action_time string, "
          "search_keyword string, click_category_id long, click_product_id long, "
          "order_category_ids string, order_product_ids string, pay_category_ids string, "
          "pay_product_ids string, city_id long, event_id long")


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    n = 3000
    for eid in range(n):
        hot = eid % 3 == 0
        sess = "hot" if hot else f"s{rnd.randrange(200)}"
        # the hot session spans two days; ties on the same second are frequent
        t = t0 + dt.timedelta(seconds=rnd.randrange(0, 2 * 86400 if hot else 4000))
        kind = rnd.choice(["search", "click", "order", "pay", "none"])
        rows.append((t.strftime("%Y-%m-%d"), 1, sess, rnd.randrange(1, 8), t.strftime("%Y-%m-%d %H:%M:%S"),
                     ("" if eid % 4 == 0 else f"w{rnd.randrange(5)}") if kind == "search" else None,
                     rnd.randrange(1, 20) if kind == "click" else -1,
                     rnd.randrange(1, 50) if kind == "click" else -1,
                     "1,2" if kind == "order" else None, f"{eid},{eid + 1}" if kind == "order" else None,
                     "3" if kind == "pay" else None, str(eid) if kind == "pay" else None, 1, eid))
    return rows


def _brute_sessions(rows):
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    df = df.sort_values(["action_time", "event_id"])
    out = {}
    for sid, g in df.groupby("session_id"):
        t = pd.to_datetime(g["action_time"])
        out[sid] = (
            int((t.max() - t.min()).total_seconds()), len(g),
            ",".join(g["search_keyword"].dropna()),
            ",".join(str(x) for x in g["click_product_id"] if x > 0),
            ",".join(g["order_product_ids"].dropna()),
            ",".join(g["pay_product_ids"].dropna()),
            list(zip(g["page_id"].iloc[:-1], g["page_id"].iloc[1:])),
        )
    return out


@pytest.mark.parametrize("chunk", [60, 3600, 86400 * 7])
def test_hot_session_lists_match_brute_force(spark, skewed, chunk):
    want = _brute_sessions(skewed)
    got = sessions.session_info(spark.createDataFrame(skewed, SCHEMA), chunk_seconds=chunk).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.session_id]
        assert (r.visit_length, r.step_length, r.search_keywords, r.click_product_ids,
                r.order_product_ids, r.pay_product_ids) == w[:6], r.session_id


@pytest.mark.parametrize("chunk", [1, 60, 86400 * 7])
def test_hot_session_items_match_brute_force(spark, skewed, chunk):
    nameless = [(*r[:2], None if r[2] == "s1" else r[2], *r[3:]) for r in skewed]  # one session without an id
    want = _brute_sessions([(*r[:2], r[2] or "-", *r[3:]) for r in nameless])
    items = sessions.session_items(spark.createDataFrame(nameless, SCHEMA), chunk_seconds=chunk)
    assert "collect_list" not in items._jdf.queryExecution().toString()  # nothing gathers a session
    got = {}
    for r in items.collect():
        assert got.setdefault((r.session_id or "-", r.list), {}).setdefault(r.position, r.value) == r.value
    lists = ("search_keywords", "click_product_ids", "order_product_ids", "pay_product_ids")
    for sid, w in want.items():
        for name, text in zip(lists, w[2:6]):
            at = got.pop((sid, name), {})
            assert sorted(at) == list(range(1, len(at) + 1))
            assert ",".join(at[k] for k in sorted(at)) == text, (sid, name)
    assert not got


def hop_counts(hops):
    return {(r.from_page, r.to_page): r.n for r in hops.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_hot_session_hops_match_brute_force(spark, skewed):
    want = {}
    for w in _brute_sessions(skewed).values():
        for a, b in w[6]:
            want[(a, b)] = want.get((a, b), 0) + 1
    assert hop_counts(funnel.page_hops(spark.createDataFrame(skewed, SCHEMA))) == want


@pytest.fixture(scope="module")
def dense(spark):
    """Every third of 24,000 actions in one session and one second."""
    rnd, t0 = random.Random(12), dt.datetime(2024, 1, 1)
    rows = [("2024-01-01", 1, "hot" if e % 3 == 0 else f"s{rnd.randrange(900)}", rnd.randrange(1, 8),
             (t0 if e % 3 == 0 else t0 + dt.timedelta(seconds=rnd.randrange(80000))).strftime("%Y-%m-%d %H:%M:%S"),
             None, -1, -1, None, None, None, None, 1, e) for e in range(24_000)]
    return rows


@pytest.fixture
def shuffled_to(spark):
    """Sets the number of shuffle partitions, which small tables would else be merged into one."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def put(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_dense_second_splits_anywhere(spark, dense, shuffled_to):
    shuffled_to(8)
    df = spark.createDataFrame(dense, SCHEMA).repartition(6)
    parts = funnel.in_order(df).select(F.spark_partition_id().alias("p"), (F.col("session_id") == "hot").cast("int").alias("hot")) \
        .groupBy("p").agg(F.count("*").alias("n"), F.sum("hot").alias("hot")).collect()
    sizes = sorted(r.n for r in parts)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
    assert sum(r.hot > 0 for r in parts) >= 2  # its one second lies in several partitions


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_hops_over_borders_of_a_dense_second(spark, dense, partitions, shuffled_to):
    shuffled_to(partitions)
    rows = dense[:3000] + [(d, u, s, p, "no time", *r) for d, u, s, p, _, *r in dense[3000:3100]]
    by = {}
    for r in sorted(rows[:3000], key=lambda r: (r[4], r[13])):
        by.setdefault(r[2], []).append(r[3])
    want = {}
    for pages in by.values():
        for a, b in zip(pages, pages[1:]):
            want[a, b] = want.get((a, b), 0) + 1
    df = spark.createDataFrame(rows, SCHEMA)
    assert hop_counts(funnel.page_hops(df)) == want
    got = {r.page_jump: (r.n, r.visits) for r in funnel.flow_counts(df, "1,2,3,3,1").collect()}
    visits = lambda p: sum(r[3] == p for r in rows)
    assert got == {f"{a}_{b}": (want[a, b], visits(a)) for a, b in [(1, 2), (2, 3), (3, 3), (3, 1)]}


def test_hops_of_odd_rows(spark, shuffled_to):
    shuffled_to(5)
    row = lambda s, p, t, e: ("2024-01-01", 1, s, p, t, None, -1, -1, None, None, None, None, 1, e)
    rows = [row(None, 1, "2024-01-01 00:00:01", 1), row(None, 2, "2024-01-01 00:00:02", 2), row("", 1, "2024-01-01 00:00:01", 3),
            row("", 2, "2024-01-01 00:00:02", 4), row("a", None, "2024-01-01 00:00:01", 5), row("a", 2, "2024-01-01 00:00:02", 6),
            row("a", None, "2024-01-01 00:00:03", 7), row("b", 1, None, 8), row("b", 2, "2024-01-01 00:00:02", 9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(map(repr, map(tuple, funnel.page_hops(df).collect())))
    assert got == sorted(map(repr, [(None, 1, 2), ("", 1, 2), ("a", None, 2)]))
    assert funnel.page_hops(df.limit(0)).count() == 0
    assert [tuple(r) for r in funnel.flow_counts(df.limit(0), "1,2").collect()] == [("1_2", 1, 0, 0)]


def test_hot_session_is_split_across_chunks(spark, skewed):
    a = sessions.with_action_ts(spark.createDataFrame(skewed, SCHEMA))
    chunks = (a.filter(F.col("session_id") == "hot")
              .select(F.countDistinct(F.floor(F.unix_seconds("action_ts") / 3600)).alias("c")).first().c)
    assert chunks >= 40  # the hot session's rows are sorted by ~48 tasks' worth of groups


def test_sliding_counts_fallback_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(3)
    log = spark.createDataFrame(
        [(t0 + dt.timedelta(seconds=rnd.randrange(0, 7200)), "A", "c", "u", str(rnd.randrange(2)), i)
         for i in range(200)],
        "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    ours = {(r.window_start, r.ads_id): r.n for r in ads.sliding_counts(log, "25 minutes", "10 minutes").collect()}
    native = {(r.w.start, r.ads_id): r.n for r in
              log.groupBy(F.window("ts", "25 minutes", "10 minutes").alias("w"), "ads_id").count()
              .withColumnRenamed("count", "n").collect()}
    assert ours == native


@pytest.mark.parametrize("threshold,chunk", [(1, 60), (50, 1), (50, 60), (700, 60), (1500, 86400)])
def test_cut_offs_with_a_hot_group(spark, threshold, chunk):
    """One (day, user, ad) holds a third of all rows; ties in time, several ads a user."""
    t0, rnd = dt.datetime(2024, 1, 1, 10), random.Random(5)
    rows = [(t0 + dt.timedelta(seconds=rnd.randrange(0, 4000)), "A", "c",
             "hot" if i % 3 == 0 else f"u{rnd.randrange(20)}", "1" if i % 3 == 0 else str(rnd.randrange(3)), i)
            for i in range(3000)]
    log = spark.createDataFrame(rows, "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    seen, want = {}, {}
    for ts, _, _, user, ad, seq in sorted(rows, key=lambda r: (r[0], r[5])):
        seen[user, ad] = seen.get((user, ad), 0) + 1
        if seen[user, ad] == threshold and user not in want:
            want[user] = seq
    got = {r.user_id: r.cut.seq for r in ads.blacklist_cutoffs(log, threshold, chunk).collect()}
    assert got == want


@pytest.mark.parametrize("k", [1, 40, 1001, 5000])
def test_sample_of_any_size_with_a_crowded_hour(spark, k):
    import hashlib
    import math
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [(f"s{i}", t0 + dt.timedelta(hours=0 if i % 3 else i % 5, seconds=i)) for i in range(3000)]
    got = sessions.sample_sessions(spark.createDataFrame(rows, "session_id string, start_ts timestamp"), k, 42)
    hours, want = {}, set()
    for r in spark.createDataFrame(rows, "session_id string, start_ts timestamp").collect():
        hours.setdefault(r.start_ts.strftime("%Y-%m-%d %H"), []).append(r.session_id)
    for ids in hours.values():
        quota = min(math.floor(len(ids) / len(rows) * float(k)), len(ids))
        want |= set(sorted(ids, key=lambda s: (hashlib.md5((s + "42").encode()).hexdigest(), s))[:quota])
    assert {r.session_id for r in got.collect()} == want
