"""Plan checks: the physical operators the design relies on are the ones Spark picks."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from shopflow.plans.catalog import QUERIES

from conftest import SF_SMALL

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "AggregateInPandas", "ArrowAggregatePython",
                "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonUDF")


def plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name,op", [
    ("area_top3_products", "WindowGroupLimit"),
    ("top_sessions_per_category", "WindowGroupLimit"),
    ("ads_area_top3", "WindowGroupLimit"),
    ("category_top10", "TakeOrderedAndProject"),
    ("top_sessions_per_category", "BroadcastExchange"),
    ("ads_log_parsed", "BroadcastHashJoin"),
])
def test_operator_present(spark, name, op):
    assert op in plan(spark, name)


def test_blacklist_needs_counts_only(spark):
    p = plan(spark, "ads_blacklist")
    assert "Window" not in p and "partial_count" in p


def test_top_k_limited_before_the_shuffle(spark):
    p = plan(spark, "top_sessions_per_category")
    assert "Partial" in p and "Final" in p  # WindowGroupLimit on both sides of the exchange


def test_no_python_in_batch_plans(spark):
    for name in QUERIES:
        if name.endswith(("_stream", "_replay")):
            continue
        p = plan(spark, name)
        # Page successors pair sorted neighbours in Arrow batches; nothing else runs Python.
        allowed = {"MapInArrow"} if name.startswith("page_") and name != "page_visit_counts" else set()
        assert {n for n in PYTHON_NODES if n in p} == allowed, name


def test_sql_remark_gets_precounted_rows(spark):
    assert "partial_count" in plan(spark, "area_city_remark_sql")


def test_conversion_reads_events_once_and_orders_them_once(spark):
    p = plan(spark, "page_convert_rate")
    tree = p.split("\n\n")[0]
    assert sum("events.parquet" in line for line in p.splitlines() if line.startswith("Location")) == 1
    assert sum("rangepartitioning(session_id" in line for line in p.splitlines()) >= 1  # the only row-volume shuffle
    assert "Exchange hashpartitioning" not in p
    assert sum(line.count("Window ") for line in tree.splitlines()) == 1  # one row per partition


def test_cut_offs_order_single_chunks(spark):
    """At the production threshold the ordered window is per (group, chunk)."""
    from shopflow.operators import ads
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ads.kept_events(ads.parse_ads_log(fx_lines(spark)), 10000).explain()
    numbered = [line for line in buf.getvalue().splitlines() if "row_number()" in line and "Window [" in line]
    assert numbered and all("_chunk" in line.split("windowspecdefinition(")[1].split("ts")[0] for line in numbered)


def fx_lines(spark):
    from shopflow.sources import fixtures as fx
    return fx.ads_lines(spark, SF_SMALL)


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "category_session_clicks")
    scans = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
    events_scan = [line for line in scans if "event_type" in line]
    assert events_scan and "value:" not in events_scan[0]
    assert any(line == "ReadSchema: struct<c_custkey:bigint>" for line in scans)


def test_bucketed_tables_semi_join_without_shuffle(spark):
    from shopflow.operators import conditions
    from shopflow.session import prepare
    from shopflow.sources import fixtures as fx
    from shopflow.sources.tables import read_table, write_bucketed
    prepare(spark)
    write_bucketed(fx.user_visit_action(spark, SF_SMALL), "sf_actions_b", "user_id", 8)
    write_bucketed(fx.user_info(spark, SF_SMALL), "sf_users_b", "user_id", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if users were too many
    try:
        joined = conditions.filter_actions(read_table(spark, "sf_actions_b"), read_table(spark, "sf_users_b"),
                                           {"gender": "M"})
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        p = buf.getvalue()
        assert "SortMergeJoin" in p and "LeftSemi" in p
        assert "Exchange hashpartitioning(user_id" not in p
        plain = conditions.filter_actions(fx.user_visit_action(spark, SF_SMALL), fx.user_info(spark, SF_SMALL),
                                          {"gender": "M"})
        rows = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
        assert rows(joined) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE sf_actions_b")
        spark.sql("DROP TABLE sf_users_b")


def test_snapshot_reads_prune_day_partitions(spark, tmp_root):
    from pyspark.sql import functions as F

    from shopflow.sources.sinks import SnapshotStore
    store = SnapshotStore(spark, f"{tmp_root}/kv", ["day", "k"], "day string, k string, n long",
                          partition_by=["day"])
    rows = [("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "b", 3)]
    store.write_batch(spark.createDataFrame(rows, "day string, k string, n long"), 0)
    df = store.read(where=F.col("day").isin(["2024-01-02"]))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    scan = [line for line in buf.getvalue().splitlines() if "FileScan" in line][0]
    assert "PartitionFilters: [" in scan and "day" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert [tuple(r) for r in df.collect()] == [("2024-01-02", "a", 2)]
