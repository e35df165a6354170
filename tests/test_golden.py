"""Hand-computed golden cases (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopflow.operators import ads, areas, categories, conditions, funnel, sessions

ACTION_SCHEMA = ("date string, user_id long, session_id string, page_id long, action_time string, "
                 "search_keyword string, click_category_id long, click_product_id long, "
                 "order_category_ids string, order_product_ids string, pay_category_ids string, "
                 "pay_product_ids string, city_id long, event_id long")


def action(eid, session="s1", time="2024-01-01 10:00:00", page=1, kw=None, ccat=-1, cprod=-1,
           ocat=None, oprod=None, pcat=None, pprod=None, city=1, user=1):
    return (time[:10], user, session, page, time, kw, ccat, cprod, ocat, oprod, pcat, pprod, city, eid)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, ACTION_SCHEMA)


def sessions_df(spark, pairs):
    return spark.createDataFrame(pairs, "visit_length long, step_length long")


# G1, G2
def test_g1_session_ratios(spark):
    r = sessions.session_ratio_stats(sessions_df(spark, [(10, 5), (11, 6), (0, 1)]), "t").first()
    assert r.session_count == 3
    assert (r.visit_length_le_10s_ratio, r.visit_length_gt_10s_ratio) == (66.67, 33.33)
    assert (r.step_length_le_5_ratio, r.step_length_gt_5_ratio) == (66.67, 33.33)


def test_g2_session_ratios_empty(spark):
    r = sessions.session_ratio_stats(sessions_df(spark, []), "t").first()
    assert r.session_count == 0
    assert [r[c] for c in r.asDict() if c.endswith("_ratio")] == [0.0] * 4


# G3
@pytest.mark.parametrize("chunk", [1, 3600])
def test_g3_session_rollup(spark, chunk):
    rows = [action(1, time="2024-01-01 10:00:05", ccat=2, cprod=7),
            action(2, time="2024-01-01 10:00:00", kw="a"),
            action(3, time="2024-01-01 10:00:09", ocat="1,2", oprod="3,4"),
            action(4, time="2024-01-01 10:00:09", pcat="1", pprod="3")]
    r = sessions.session_info(actions_df(spark, rows), chunk_seconds=chunk).first()
    assert (r.visit_length, r.step_length, r.start_time) == (9, 4, "2024-01-01 10:00:00")
    assert (r.search_keywords, r.click_product_ids, r.order_product_ids, r.pay_product_ids) == \
        ("a", "7", "3,4", "3")


def test_session_rollup_order_across_chunks(spark):
    rows = [action(i, time=f"2024-01-01 10:{m:02d}:00", kw=f"w{m}") for i, m in enumerate([30, 5, 59, 0, 17])]
    rows.append(action(9, session="s2", time="2024-01-01 11:00:00"))
    out = {r.session_id: r for r in sessions.session_info(actions_df(spark, rows), chunk_seconds=60).collect()}
    assert out["s1"].search_keywords == "w0,w5,w17,w30,w59"
    assert out["s1"].visit_length == 59 * 60
    assert out["s2"].search_keywords == "" and out["s2"].step_length == 1


# G4
def test_g4_category_counts(spark):
    rows = [action(1, ccat=5, cprod=1, ocat="7,8"), action(2, ocat="7,8,"), action(3, pcat="7"),
            action(4, kw="x")]
    counts = {r.category_id: (r.click_count, r.order_count, r.pay_count)
              for r in categories.category_counts(actions_df(spark, rows)).collect()}
    assert counts == {"5": (1, 0, 0), "7": (0, 1, 1), "8": (0, 1, 0)}
    top = [r.category_id for r in categories.category_top(
        categories.category_counts(actions_df(spark, rows)), 10).collect()]
    assert top == ["5", "7", "8"]
    bottom = [r.category_id for r in categories.category_top(
        categories.category_counts(actions_df(spark, rows)), 1, ascending=True).collect()]
    assert bottom == ["8"]


# G5
def test_g5_sample_quota(spark):
    s = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 10, 1)), ("b", dt.datetime(2024, 1, 1, 10, 2)),
         ("c", dt.datetime(2024, 1, 1, 10, 3)), ("d", dt.datetime(2024, 1, 1, 11, 0))],
        "session_id string, start_ts timestamp")
    q2 = {r.day_hour: r.quota for r in sessions.session_hour_quota(s, 2).collect()}
    assert q2 == {"2024-01-01 10": 1, "2024-01-01 11": 0}
    q = {r.day_hour: r.quota for r in sessions.session_hour_quota(s, 1000).collect()}
    assert q == {"2024-01-01 10": 3, "2024-01-01 11": 1}
    sample = sessions.sample_sessions(s, 1000).collect()
    assert sorted(r.session_id for r in sample) == ["a", "b", "c", "d"]
    assert len(sessions.sample_sessions(s, 2).collect()) == 1


# G6
def test_g6_conversion(spark):
    rows, eid = [], 0
    for sess, pages in (("s1", [1, 2, 3, 1, 2]), ("s2", [2, 3]), ("s3", [1])):
        for sec, p in enumerate(pages):
            eid += 1
            rows.append(action(eid, session=sess, page=p, time=f"2024-01-01 10:00:{sec * 7:02d}"))
    df = actions_df(spark, rows)
    visits = {r.page_id: r.n for r in funnel.page_visit_counts(df, "1,2,3,4,5,6,7").collect()}
    assert visits == {1: 3, 2: 3, 3: 2}
    hops = {r.page_jump: r.n for r in funnel.page_jump_counts(df, "1,2,3,4,5,6,7").collect()}
    assert hops == {"1_2": 2, "2_3": 2}
    rates = {r.page_jump: r.rate for r in funnel.page_convert_rate(df, "1,2,3,4,5,6,7").collect()}
    assert rates == {"1_2": 66.7, "2_3": 66.7}
    full = {r.page_jump: r.rate for r in funnel.page_convert_rate(df, [1, 2, 3, 4], include_zero=True).collect()}
    assert full == {"1_2": 66.7, "2_3": 66.7, "3_4": 0.0}


# G7, G8
def _remark(spark, counts):
    cities = spark.createDataFrame([(i, name, "X") for i, name in enumerate(counts, 1)],
                                   "city_id long, city_name string, area string")
    rows, eid = [], 0
    for i, (name, n) in enumerate(counts.items(), 1):
        for _ in range(n):
            eid += 1
            rows.append(action(eid, ccat=1, cprod=9, city=i))
    return areas.area_city_remark(actions_df(spark, rows), cities).first().city_remark


def test_g7_city_remark(spark):
    assert _remark(spark, {"A": 3, "B": 2, "C": 1}) == "A:50.0%,B:33.3%,其他:16.7%"


def test_g8_city_remark_small(spark):
    assert _remark(spark, {"A": 1, "B": 2}) == "B:66.7%,A:33.3%"
    assert _remark(spark, {"A": 4}) == "A:100.0%"


def test_city_remark_sql_matches_builtin(spark):
    from shopflow.functions.city_remark import area_city_remark_sql
    cities = spark.createDataFrame([(1, "A", "X"), (2, "B", "X"), (3, "C_1", "X"), (4, "D", "Y")],
                                   "city_id long, city_name string, area string")
    rows = [action(i, ccat=1, cprod=i % 3 + 1, city=i % 4 + 1) for i in range(40)]
    df = actions_df(spark, rows)
    a = {(r.area, r.click_product_id): r.city_remark for r in areas.area_city_remark(df, cities).collect()}
    b = {(r.area, r.click_product_id): r.city_remark for r in area_city_remark_sql(spark, df, cities).collect()}
    assert a == b


# G9, G10
def _top(spark, clicks, products=None):
    cities = spark.createDataFrame([(1, "c", "X")], "city_id long, city_name string, area string")
    rows, eid = [], 0
    for prod, n in clicks.items():
        for _ in range(n):
            eid += 1
            rows.append(action(eid, ccat=1, cprod=prod))
    prods = spark.createDataFrame([(p, f"p{p}", "") for p in (products or clicks)],
                                  "product_id long, product_name string, extend_info string")
    return sorted((r.product_name, r.rk) for r in
                  areas.area_top_products(actions_df(spark, rows), cities, prods).collect())


def test_g9_rank_ties(spark):
    assert _top(spark, {1: 5, 2: 4, 3: 4, 4: 3}) == [("p1", 1), ("p2", 2), ("p3", 2)]
    assert _top(spark, {1: 5, 2: 4, 3: 3, 4: 3}) == [("p1", 1), ("p2", 2), ("p3", 3), ("p4", 3)]


def test_g10_unknown_product(spark):
    assert _top(spark, {1: 5, 2: 4, 3: 3, 4: 2}, products=[2, 3, 4]) == [("p2", 2), ("p3", 3)]


# G11
def test_g11_top_sessions_ties(spark):
    rows = [action(i, session=f"s{i:02d}", ccat=3, cprod=1) for i in range(12)]
    df = actions_df(spark, rows)
    top = categories.category_top(categories.category_counts(df), 10)
    out = categories.top_sessions_per_category(df, top, 10).collect()
    assert sorted(r.session_id for r in out) == [f"s{i:02d}" for i in range(10)]


# G12 (per-event rule, batch)
def test_g12_blacklist_per_event(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    log = spark.createDataFrame(
        [(t0 + dt.timedelta(seconds=i), "A", "c", "u", "1", i) for i in range(3)]
        + [(t0 + dt.timedelta(seconds=10), "A", "c", "u", "2", 10),
           (t0, "A", "c", "v", "1", 20)],
        "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    assert [r.user_id for r in ads.blacklist(log, 2).collect()] == ["u"]
    kept = sorted((r.user_id, r.seq) for r in ads.kept_events(log, 2).collect())
    assert kept == [("u", 0), ("u", 1), ("v", 20)]


# G14
def test_g14_last_hour(spark):
    log = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23, 5), "A", "c", "u", "1", 1),
         (dt.datetime(2024, 1, 1, 23, 50), "A", "c", "u", "1", 2),
         (dt.datetime(2024, 1, 2, 0, 5), "A", "c", "u", "1", 3)],
        "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    counts = ads.last_hour(log, as_of="2024-01-02 00:10:00")
    assert sorted(r.minute for r in counts.collect()) == ["2024-01-01 23:50", "2024-01-02 00:05"]
    js = ads.last_hour_json(counts).first().series_json
    assert js == '[{"23:50":1},{"00:05":1}]'


# G15
def test_g15_ads_line(spark):
    lines = spark.createDataFrame([("x a b c d", 1), ("1 a b", 2), ("1 a b c d e", 3), ("2 a b c d  ", 4)],
                                  "value string, seq long")
    good, bad = ads.parse_ads_log_with_rejects(lines)
    g = sorted((r.seq, r.area, r.city, r.user_id, r.ads_id) for r in good.collect())
    assert g == [(3, "a", "b", "c", "d"), (4, "a", "b", "c", "d")]
    assert sorted((r.seq, r.reason) for r in bad.collect()) == \
        [(1, "time is not a number"), (2, "fewer than 5 fields")]


# G16
def test_g16_blank_parameters(spark):
    rows = [action(1, user=1), action(2, user=2), action(3, user=3)]
    users = spark.createDataFrame([(1, "a", "a", 20, "p", "M"), (2, "b", "b", 30, "q", "F")],
                                  "user_id long, username string, name string, age int, professional string, gender string")
    df = actions_df(spark, rows)
    blank = {k: "" for k in conditions.FIELDS}
    assert conditions.filter_actions(df, users, blank).count() == 2
    assert conditions.filter_actions(df, users, "{}").count() == 2
    assert conditions.filter_actions(df, users, '{"gender": "F", "professionals": "q"}').count() == 1
    assert conditions.filter_actions(df, users, {"startAge": "25", "city": 1}).count() == 1
    assert conditions.filter_actions(df, users, {"startDate": "2024-1-1", "endDate": "2024-01-1"}).count() == 2
    assert conditions.filter_actions(df, users, {"startDate": "2024-1-2"}).count() == 0


# G17
def test_g17_keys_with_blank_and_underscore(spark):
    log = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 1), "MIDDLE EAST", "NATION_0", "u", "1", 1),
         (dt.datetime(2024, 1, 1, 2), "MIDDLE EAST", "NATION_0", "u", "1", 2),
         (dt.datetime(2024, 1, 1, 3), "MIDDLE", "EAST_NATION_0", "u", "1", 3)],
        "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    out = sorted((r.area, r.city, r.n) for r in ads.area_city_daily(log).collect())
    assert out == [("MIDDLE", "EAST_NATION_0", 1), ("MIDDLE EAST", "NATION_0", 2)]


def test_sliding_counts_match_window(spark):
    import random
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600)), "A", "c", "u", str(rnd.randrange(3)), i)
            for i in range(300)]
    log = spark.createDataFrame(rows, "ts timestamp, area string, city string, user_id string, ads_id string, seq long")
    ours = {(r.window_start, r.ads_id): r.n for r in ads.sliding_counts(log, "60 minutes", "10 minutes").collect()}
    native = {(r.w.start, r.ads_id): r.n for r in log.groupBy(F.window("ts", "60 minutes", "10 minutes").alias("w"), "ads_id")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert ours == native


def test_area_top_ads_map_and_json(spark):
    totals = spark.createDataFrame(
        [("2024-01-01", "A", "c1", "1", 5), ("2024-01-01", "A", "c2", "1", 2), ("2024-01-01", "A", "c1", "2", 7),
         ("2024-01-01", "A", "c1", "3", 1), ("2024-01-01", "A", "c1", "4", 1), ("2024-01-01", "B", "c3", "9", 4)],
        "day string, area string, city string, ads_id string, n long")
    top = ads.area_top_ads(totals, 3)
    js = {(r.date_key, r.area): r.top3_json for r in ads.area_top_ads_json(top).collect()}
    assert js == {("area_top3_ads:2024-01-01", "A"): '[{"1":7},{"2":7},{"3":1}]',
                  ("area_top3_ads:2024-01-01", "B"): '[{"9":4}]'}
    m = ads.area_top_ads_map(ads.area_top_ads_json(top)).first()
    assert m.date_key == "area_top3_ads:2024-01-01" and set(m.areas) == {"A", "B"}


def test_unparsable_action_time_is_rejected_not_counted(spark):
    rows = [action(1, time="2024-01-01 10:00:00"), action(2, time="2024-01-01 10:00:07"),
            action(3, time="not a time")]
    df = actions_df(spark, rows)
    assert [r.reason for r in sessions.rejected_actions(df).collect()] == ["unparsable action_time"]
    r = sessions.session_info(df).first()
    assert (r.step_length, r.visit_length) == (2, 7)
