"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per question / operator.

Every callable reads the given tables in full (through the views of ``sources/fixtures.py``)
and returns a DataFrame whose column names equal the oracle's (``plans/oracle.py``). Batch queries
are lazy; the streaming ones (``*_stream``, ``*_replay``) run while the frame is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators import ads, areas, categories, conditions, funnel, sessions
from shopflow.schemas import USER_VISIT_ACTION, bind
from shopflow.session import fresh_dir, prepare
from shopflow.sources import fixtures as fx
from shopflow.streaming import ads_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- areas
@query
def area_product_clicks(spark, base):
    prepare(spark)
    return areas.area_product_clicks(fx.user_visit_action(spark, base), fx.city_info(spark, base))


@query
def area_city_remark(spark, base):
    prepare(spark)
    return areas.area_city_remark(fx.user_visit_action(spark, base), fx.city_info(spark, base)) \
        .select("area", "click_product_id", "city_remark")


@query
def area_top3_products(spark, base):
    prepare(spark)
    return areas.area_top_products(fx.user_visit_action(spark, base), fx.city_info(spark, base),
                                   fx.product_info(spark, base), n=3)


# ---------------------------------------------------------------- parameters and base frames
# Request used by ``filtered_actions``: dates, ages and gender.
FILTER_PARAMS = {"startDate": "2024-01-05", "endDate": "2024-01-20", "startAge": "20",
                 "endAge": "45", "gender": "M"}
TASK_ID = "task-1"
FLOW = "1,2,3,4,5,6,7"


def _actions(spark, base, params=None):
    """Actions of known users passing the request filters (blank request = no filter)."""
    return conditions.filter_actions(fx.user_visit_action(spark, base), fx.user_info(spark, base),
                                     params or {})


@query
def filtered_actions(spark, base):
    prepare(spark)
    return bind(_actions(spark, base, FILTER_PARAMS), USER_VISIT_ACTION)  # S2: fixed schema by name


# ---------------------------------------------------------------- sessions
@query
def session_info(spark, base):
    prepare(spark)
    return sessions.session_info(_actions(spark, base))


@query
def session_items(spark, base):
    prepare(spark)
    return sessions.session_items(_actions(spark, base))


@query
def session_counts(spark, base):
    prepare(spark)
    return sessions.session_counts(sessions.session_stats(_actions(spark, base)))


@query
def session_ratio_stats(spark, base):
    prepare(spark)
    return sessions.session_ratio_stats(sessions.session_stats(_actions(spark, base)), TASK_ID,
                                        conditions.conditions_json({}))


@query
def session_hour_quota(spark, base):
    prepare(spark)
    return sessions.session_hour_quota(sessions.session_stats(_actions(spark, base)), k=1000)


@query
def session_sample(spark, base):
    prepare(spark)
    return sessions.sample_sessions(sessions.session_stats(_actions(spark, base)), k=1000, seed=42) \
        .select("session_id", "day_hour")


# ---------------------------------------------------------------- categories
@query
def category_action_counts(spark, base):
    prepare(spark)
    return categories.category_action_counts(_actions(spark, base))


@query
def category_counts(spark, base):
    prepare(spark)
    return categories.category_counts(_actions(spark, base))


@query
def category_top10(spark, base):
    prepare(spark)
    return categories.category_top(categories.category_counts(_actions(spark, base)), n=10)


@query
def category_session_clicks(spark, base):
    prepare(spark)
    return categories.category_session_clicks(_actions(spark, base))


@query
def top_sessions_per_category(spark, base):
    prepare(spark)
    acts = _actions(spark, base)
    top = categories.category_top(categories.category_counts(acts), n=10)
    return categories.top_sessions_per_category(acts, top, n=10)


# ---------------------------------------------------------------- page flow
@query
def page_visit_counts(spark, base):
    prepare(spark)
    return funnel.page_visit_counts(_actions(spark, base), FLOW)


@query
def page_jump_counts(spark, base):
    prepare(spark)
    return funnel.page_jump_counts(_actions(spark, base), FLOW).select("page_jump", "n")


@query
def page_convert_rate(spark, base):
    prepare(spark)
    return funnel.page_convert_rate(_actions(spark, base), FLOW)


# ---------------------------------------------------------------- ad clicks (R7-R10), batch form
BLACKLIST_THRESHOLD = 3  # small enough that the test data lists users (the default is 10000)


def _ads_log(spark, base):
    return ads.parse_ads_log(fx.ads_lines(spark, base))


@query
def ads_log_parsed(spark, base):
    prepare(spark)
    log = _ads_log(spark, base)
    return log.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
                      "area", "city", "user_id", "ads_id")


@query
def ads_area_city_daily(spark, base):
    prepare(spark)
    return ads.area_city_daily(_ads_log(spark, base))


@query
def ads_area_daily(spark, base):
    prepare(spark)
    return ads.area_daily(ads.area_city_daily(_ads_log(spark, base)))


@query
def ads_area_top3(spark, base):
    prepare(spark)
    return ads.area_top_ads(ads.area_city_daily(_ads_log(spark, base)), n=3)


@query
def ads_area_top3_json(spark, base):
    prepare(spark)
    return ads.area_top_ads_json(ads.area_top_ads(ads.area_city_daily(_ads_log(spark, base)), n=3))


@query
def ads_user_daily(spark, base):
    prepare(spark)
    return ads.user_daily(_ads_log(spark, base))


@query
def ads_blacklist(spark, base):
    prepare(spark)
    return ads.blacklist(_ads_log(spark, base), BLACKLIST_THRESHOLD)


@query
def ads_kept_events(spark, base):
    prepare(spark)
    kept = ads.kept_events(_ads_log(spark, base), BLACKLIST_THRESHOLD)
    return kept.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
                       "area", "city", "user_id", "ads_id")


@query
def ads_last_hour(spark, base):
    prepare(spark)
    return ads.last_hour(_ads_log(spark, base)).select("ads_id", "minute", "n")


@query
def ads_last_hour_json(spark, base):
    prepare(spark)
    return ads.last_hour_json(ads.last_hour(_ads_log(spark, base)))


@query
def ads_sliding_counts(spark, base):
    prepare(spark)
    s = ads.sliding_counts(_ads_log(spark, base), "60 minutes", "10 minutes")
    return s.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "ads_id", "n")


@query
def area_city_remark_sql(spark, base):
    prepare(spark)
    from shopflow.functions.city_remark import area_city_remark_sql as via_sql
    return via_sql(spark, fx.user_visit_action(spark, base), fx.city_info(spark, base)).drop("clickcount")


@query
def area_top3_products_sql(spark, base):
    """The area question as SQL text, with the remark as an aggregate beside count(*)."""
    prepare(spark)
    from shopflow.functions.city_remark import area_top_products_sql
    return area_top_products_sql(spark, fx.user_visit_action(spark, base), fx.city_info(spark, base),
                                 fx.product_info(spark, base))


# ---------------------------------------------------------------- ad clicks, streaming form
# The events table is read as a file stream (availableNow), the results are read back from the
# snapshot folders the streaming jobs wrote (below spark.checkpoint.dir).
def _cores(spark):
    """State partitions for the catalogue's streams: one per core (a stream keeps the number)."""
    return spark.sparkContext.defaultParallelism


def _ads_stream(spark, base):
    return ads.parse_ads_log(ads_stream.event_lines(spark, base))


@query
def ads_area_city_daily_stream(spark, base):
    prepare(spark)
    root = fresh_dir(spark, "ads_area_city_daily")
    ads_stream.run_available(ads_stream.start_area_city_daily(
        _ads_stream(spark, base), root, trigger={"availableNow": True},
        state_partitions=_cores(spark)))
    return ads_stream.daily_totals(spark, root)


@query
def ads_area_top3_stream(spark, base):
    prepare(spark)
    root = fresh_dir(spark, "ads_area_top3")
    ads_stream.run_available(ads_stream.start_area_city_daily(
        _ads_stream(spark, base), root, trigger={"availableNow": True},
        state_partitions=_cores(spark)))
    top = ads_stream.daily_top(spark, root)
    return top.select("day", "area", "ads_id", "n", "rn")


@query
def ads_blacklist_stream(spark, base):
    prepare(spark)
    root = fresh_dir(spark, "ads_blacklist")
    ads_stream.run_available(ads_stream.start_blacklist(
        _ads_stream(spark, base), root, threshold=BLACKLIST_THRESHOLD, trigger={"availableNow": True},
        state_partitions=_cores(spark)))
    return ads_stream.blacklist_store(spark, root).read()


@query
def ads_last_hour_stream(spark, base):
    prepare(spark)
    root = fresh_dir(spark, "ads_last_hour")
    ads_stream.run_available(ads_stream.start_last_hour(
        _ads_stream(spark, base), root, trigger={"availableNow": True},
        state_partitions=_cores(spark)))
    return ads_stream.last_hour_store(spark, root).read_latest().select("ads_id", "minute", "n")


@query
def ads_kept_events_stream(spark, base):
    """Event-exact blacklist filter on the stream (threshold 3), read back from its kept events."""
    prepare(spark)
    root = fresh_dir(spark, "ads_kept_events")
    ads_stream.run_available(ads_stream.start_blacklist(
        _ads_stream(spark, base), root, threshold=BLACKLIST_THRESHOLD, trigger={"availableNow": True},
        rule="per_event", keep_events=True, state_partitions=_cores(spark)))
    kept = ads_stream.kept_events_store(spark, root).read_all()
    return kept.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
                       "area", "city", "user_id", "ads_id")


# ---------------------------------------------------------------- request options
@query
def session_ratio_stats_filtered(spark, base):
    """R1 for a request with dates, ages and gender."""
    prepare(spark)
    return sessions.session_ratio_stats(sessions.session_stats(_actions(spark, base, FILTER_PARAMS)),
                                        TASK_ID, conditions.conditions_json(FILTER_PARAMS))


@query
def page_convert_rate_zero(spark, base):
    """R5 for a flow with a page that is never visited, hops that never happen kept as 0.0."""
    prepare(spark)
    return funnel.page_convert_rate(_actions(spark, base), "1,3,5,9", include_zero=True)


@query
def category_bottom10(spark, base):
    """The ten least active categories (the reference's comparator order, D5)."""
    prepare(spark)
    return categories.category_top(categories.category_counts(_actions(spark, base)), n=10,
                                   ascending=True)


@query
def ads_area_top3_json_stream(spark, base):
    """The per-day top-3 JSON (the reference's ``area_top3_ads:<day>`` hashes) from the stream."""
    prepare(spark)
    root = fresh_dir(spark, "ads_area_top3_json")
    ads_stream.run_available(ads_stream.start_area_city_daily(
        _ads_stream(spark, base), root, trigger={"availableNow": True},
        state_partitions=_cores(spark)))
    return ads_stream.daily_top_json(spark, root)


# ---------------------------------------------------------------- request text, rejects, repeated hops, maps
REQUEST_TEXT = '{"professionals": "BUILDING", "city": "7", "startAge": "", "gender": null}'


@query
def session_ratio_stats_request(spark, base):
    """R1 for a request given as JSON text, by profession and city (blank and null fields: no filter)."""
    prepare(spark)
    return sessions.session_ratio_stats(sessions.session_stats(_actions(spark, base, REQUEST_TEXT)),
                                        TASK_ID, conditions.conditions_json(REQUEST_TEXT))


@query
def page_convert_rate_repeat(spark, base):
    """R5 for a flow that repeats a hop: listed once."""
    prepare(spark)
    return funnel.page_convert_rate(_actions(spark, base), "1,2,1,2", include_zero=True)


def _spoilt_lines(spark, base):
    """The ad lines of all events, every 97th without its last field, every 89th with a time that is no number."""
    lines, seq = fx.ads_lines(spark, base), F.col("seq")
    value = (F.when(seq % 97 == 0, F.regexp_replace("value", " [^ ]*$", ""))
             .when(seq % 89 == 0, F.concat(F.lit("x"), F.col("value"))).otherwise(F.col("value")))
    return lines.select(value.alias("value"), "seq")


@query
def ads_log_rejects(spark, base):
    """Lines that do not parse, with the reason."""
    prepare(spark)
    return ads.parse_ads_log_with_rejects(_spoilt_lines(spark, base))[1]


@query
def ads_area_top3_map(spark, base):
    """Per day the map of areas to their top list (A15), its entries in area order as text."""
    prepare(spark)
    top = ads.area_top_ads(ads.area_city_daily(_ads_log(spark, base)), n=3)
    entries = F.array_sort(F.map_entries("areas"))
    return ads.area_top_ads_map(ads.area_top_ads_json(top)).select(
        "date_key", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
        .alias("areas"))


@query
def ads_area_city_daily_kept(spark, base):
    """Daily totals of the events that pass the blacklist (D14, ``exclude_blacklisted``)."""
    prepare(spark)
    return ads.area_city_daily(ads.kept_events(_ads_log(spark, base), BLACKLIST_THRESHOLD))


# ---------------------------------------------------------------- streams in several batches
def _sliding_stream(spark, base, slide):
    prepare(spark)
    root = fresh_dir(spark, "ads_sliding")
    ads_stream.run_available(ads_stream.start_sliding_counts(
        _ads_stream(spark, base), root, slide=slide, trigger={"availableNow": True}, state_partitions=_cores(spark)))
    return ads_stream.sliding_counts_so_far(spark, root, slide=slide)


@query
def ads_sliding_counts_stream(spark, base):
    return _sliding_stream(spark, base, "10 minutes").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "ads_id", "n")


@query
def ads_sliding_fine_stream(spark, base):
    """60 minutes every minute, as a dashboard reads it: per ad, the windows with clicks, their clicks and
    the busiest of them."""
    w = _sliding_stream(spark, base, "1 minute")
    return w.groupBy("ads_id").agg(F.count("*").alias("windows"), F.sum("n").alias("clicks"), F.max("n").alias("most"))


def _replayed(spark, base, name, start, **options):
    prepare(spark)
    root = fresh_dir(spark, name)
    ads_stream.replay(spark, base, root, lambda log: start(
        log, root, trigger={"availableNow": True}, state_partitions=_cores(spark), **options))
    return root


@query
def ads_blacklist_replay(spark, base):
    """All events in three time-ordered batches: the list is re-read and totals carried on."""
    root = _replayed(spark, base, "ads_blacklist", ads_stream.start_blacklist, threshold=BLACKLIST_THRESHOLD)
    return ads_stream.blacklist_store(spark, root).read()


@query
def ads_area_city_daily_replay(spark, base):
    """All events in three time-ordered batches: state and stored totals carried on."""
    root = _replayed(spark, base, "ads_area_city_daily", ads_stream.start_area_city_daily)
    return ads_stream.daily_totals(spark, root)


@query
def ads_last_hour_replay(spark, base):
    """All events in three time-ordered batches: the last result replaces the others."""
    root = _replayed(spark, base, "ads_last_hour", ads_stream.start_last_hour)
    return ads_stream.last_hour_store(spark, root).read_latest().select("ads_id", "minute", "n")
