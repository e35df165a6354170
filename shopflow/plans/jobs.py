"""Job-level entry points: the reference's three applications as Spark jobs.

* ``offline_job``  - R1-R5 on one filtered action set (the reference's offline application):
  the session table is built once and persisted for the questions that read it; every result
  is stamped with the run's task id.
* ``area_job``     - R6, top products per area with city shares.
* ``realtime_job`` - R7-R10 and rejected lines: four streaming queries on one parsed ad-click stream.

Results are DataFrames; a ``sink(name, df)`` callable writes them (``table_sink`` replaces
managed tables, ``jdbc_sink`` appends to JDBC tables as the reference did).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators import ads, areas, categories, conditions, funnel, sessions
from shopflow.sources import sinks
from shopflow.streaming import ads_stream

Sink = Callable[[str, DataFrame], None]

# Column names of the existing result tables, where they differ from ours.
STORED_COLUMNS = {
    "session_stat": {"task_id": "taskId",
                     "visit_length_le_10s_ratio": "session_visitLength_le_10s_ratio",
                     "visit_length_gt_10s_ratio": "session_visitLength_gt_10s_ratio",
                     "step_length_le_5_ratio": "session_stepLength_le_5_ratio",
                     "step_length_gt_5_ratio": "session_stepLength_gt_5_ratio"},
    "random_session_info": {"task_id": "taskId", "session_id": "sessionId", "visit_length": "visitLength",
                            "step_length": "stepLength", "start_time": "startTime",
                            "search_keywords": "searchKeywords", "click_product_ids": "clickProductIds",
                            "order_product_ids": "orderProductIds", "pay_product_ids": "payProductIds"},
    "category_top10": {"task_id": "taskId"},
    "top10_session_per_top10_cid": {"task_id": "taskId", "session_id": "sessionId", "click_count": "clickCount"},
    "page_convert_rate": {"task_id": "taskId", "page_jump": "pageJump"},
}


def stored_names(sink: Sink) -> Sink:
    """A sink that writes each result under the column names of the existing tables, so that an
    append to a table the earlier system filled fits: ``offline_job(..., sink=stored_names(jdbc_sink(url)))``."""
    return lambda name, df: sink(name, df.withColumnsRenamed(STORED_COLUMNS.get(name, {})))


def table_sink(database: str | None = None) -> Sink:
    return lambda name, df: sinks.overwrite_table(df, name, database)


def jdbc_sink(url: str, user: str | None = None, password: str | None = None,
              options: dict | None = None) -> Sink:
    return lambda name, df: sinks.append_jdbc(df, url, name, user, password, options)


def offline_job(spark: SparkSession, actions: DataFrame, users: DataFrame, params=None,
                task_id: str | None = None, sample_size: int = sessions.SAMPLE_SIZE, seed: int = 42,
                top_n: int = 10, sink: Sink | None = None,
                storage_level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                persist_actions: bool = False) -> dict[str, DataFrame]:
    """R1-R5 for one request. Returns the five result tables under the reference's names, and
    the actions whose time does not parse (``rejected_actions``).

    The session table (one row per session, read by R1 and R2) is persisted. The filtered
    actions are not by default: each question reads only a few of their columns, and a
    column-pruned re-scan of parquet costs less than holding every column of every action;
    ``persist_actions=True`` caches them when they are small or expensive to recompute.
    With a ``sink`` the results are written and the persisted frames released; without one the
    caller owns the returned frames (and may ``unpersist`` ``_actions`` and ``_sessions``).
    Persisted blocks lost with an executor are recomputed from the plan, which is deterministic.
    """
    task_id = task_id or str(uuid.uuid4())
    cond_text = conditions.conditions_json(params)
    flow = conditions.target_flow(params)
    acts = conditions.filter_actions(actions, users, params)
    if persist_actions:
        acts = acts.persist(storage_level)
    sess = sessions.session_info(acts).persist(storage_level)
    tid = F.lit(task_id).alias("task_id")

    counts = categories.category_counts(acts)
    top = categories.category_top(counts, top_n)
    results = {
        "session_stat": sessions.session_ratio_stats(sess, task_id, cond_text),
        "random_session_info": sessions.sample_sessions(sess, sample_size, seed)
        .select(tid, *[c for c in sess.columns]),
        "category_top10": top.select(tid, "category_id", "click_count", "order_count", "pay_count"),
        "top10_session_per_top10_cid": categories.top_sessions_per_category(acts, top, top_n)
        .select(tid, "category_id", "session_id", "click_count"),
        "page_convert_rate": funnel.page_convert_rate(acts, flow).select(tid, "page_jump", "rate"),
        "rejected_actions": sessions.rejected_actions(acts).select(tid, *acts.columns, "reason"),
    }
    results["_actions"], results["_sessions"] = acts, sess
    if sink is not None:
        for name, df in results.items():
            if not name.startswith("_"):
                sink(name, df)
        sess.unpersist()
        if persist_actions:
            acts.unpersist()
    return results


def area_job(actions: DataFrame, cities: DataFrame, products: DataFrame, n: int = 3,
             sink: Sink | None = None, name: str = "area_top3_product") -> DataFrame:
    """R6 on the unfiltered actions (D23); the caller may pass a filtered frame instead."""
    out = areas.area_top_products(actions, cities, products, n)
    if sink is not None:
        sink(name, out)
    return out


def realtime_job(lines: DataFrame, root: str, threshold: int = ads.BLACKLIST_THRESHOLD,
                 trigger: dict | None = None, watermark: str | None = None,
                 blacklist_rule: str = "per_batch") -> list:
    """R7-R10 on one stream of ad-click lines (``value`` and ``seq`` columns): the blacklist,
    the daily totals with the top ads, the last hour and the lines that do not parse, each with its
    own checkpoint under ``root``. Statistics use the unfiltered stream, as the reference did (D14)."""
    log, rejected = ads.parse_ads_log_with_rejects(lines)
    # "per_batch" (the reference's behaviour) or "per_event"
    black = ads_stream.start_blacklist(log, f"{root}/blacklist", threshold, trigger, rule=blacklist_rule)
    daily = ads_stream.start_area_city_daily(log, f"{root}/daily", trigger, watermark)
    hour = ads_stream.start_last_hour(log, f"{root}/last_hour", trigger)
    return [black, daily, hour, ads_stream.start_rejects(rejected, f"{root}/rejects", trigger)]
