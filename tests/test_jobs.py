"""Job entry points end in the same results as the catalogue queries."""

from shopflow.plans import catalog, jobs
from shopflow.session import prepare
from shopflow.sources import fixtures as fx

from conftest import SF_SMALL


def _set(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_offline_job_matches_catalogue(spark):
    prepare(spark)
    written = {}
    res = jobs.offline_job(spark, fx.user_visit_action(spark, SF_SMALL), fx.user_info(spark, SF_SMALL),
                           params={}, task_id="task-1",
                           sink=lambda name, df: written.__setitem__(name, df.collect()))
    assert set(written) == {"session_stat", "random_session_info", "category_top10",
                            "top10_session_per_top10_cid", "page_convert_rate", "rejected_actions"}
    assert written["rejected_actions"] == []
    stat = catalog.session_ratio_stats(spark, SF_SMALL).collect()
    assert [r.asDict() for r in written["session_stat"]] == [r.asDict() for r in stat]
    top = _set(catalog.category_top10(spark, SF_SMALL), ["category_id", "click_count"])
    assert sorted((r.category_id, r.click_count) for r in written["category_top10"]) == top
    rates = _set(catalog.page_convert_rate(spark, SF_SMALL), ["page_jump", "rate"])
    assert sorted((r.page_jump, r.rate) for r in written["page_convert_rate"]) == rates
    sample = _set(catalog.session_sample(spark, SF_SMALL), ["session_id"])
    assert sorted((r.session_id,) for r in written["random_session_info"]) == sample
    assert all(r.task_id == "task-1" for r in written["top10_session_per_top10_cid"])
    assert not res["_actions"].is_cached
    stored = {}
    for name, df in res.items():
        jobs.stored_names(lambda n, d: stored.__setitem__(n, d.columns))(name, df)
    assert stored["session_stat"] == ["taskId", "conditions", "session_count", "session_visitLength_le_10s_ratio",
                                      "session_visitLength_gt_10s_ratio", "session_stepLength_le_5_ratio",
                                      "session_stepLength_gt_5_ratio"]
    assert stored["top10_session_per_top10_cid"] == ["taskId", "category_id", "sessionId", "clickCount"]
    assert stored["page_convert_rate"] == ["taskId", "pageJump", "rate"]
    assert stored["random_session_info"] == ["taskId", "sessionId", "visitLength", "stepLength", "startTime",
                                             "searchKeywords", "clickProductIds", "orderProductIds", "payProductIds"]


def test_area_job_writes_table(spark):
    prepare(spark)
    out = jobs.area_job(fx.user_visit_action(spark, SF_SMALL), fx.city_info(spark, SF_SMALL),
                        fx.product_info(spark, SF_SMALL), sink=jobs.table_sink())
    assert spark.table("area_top3_product").count() == out.count() > 0
    spark.sql("DROP TABLE area_top3_product")


def test_realtime_job_runs_its_queries(spark, tmp_root):
    from shopflow.streaming import ads_stream
    prepare(spark)
    lines = ads_stream.event_lines(spark, SF_SMALL)
    spoilt = lines.selectExpr("'no time' AS value", "-seq AS seq").where("seq = -1")
    qs = jobs.realtime_job(lines.unionByName(spoilt), tmp_root, threshold=3,
                           trigger={"availableNow": True})
    for q in qs:
        ads_stream.run_available(q)
    assert ads_stream.blacklist_store(spark, f"{tmp_root}/blacklist").read().count() == \
        catalog.ads_blacklist(spark, SF_SMALL).count()
    assert ads_stream.daily_totals(spark, f"{tmp_root}/daily").count() == \
        catalog.ads_area_city_daily(spark, SF_SMALL).count()
    assert ads_stream.last_hour_store(spark, f"{tmp_root}/last_hour").read_latest().count() == \
        catalog.ads_last_hour(spark, SF_SMALL).count()
    rejects = ads_stream.rejects_store(spark, f"{tmp_root}/rejects").read_all().collect()
    assert [(r.value, r.reason) for r in rejects] == [("no time", "fewer than 5 fields")]
