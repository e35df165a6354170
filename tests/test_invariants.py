"""Invariants on the test tables and a property test of the city remark."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.operators import areas
from shopflow.plans import catalog
from shopflow.sources import fixtures as fx

from conftest import SF_ORACLE

BASE = SF_ORACLE


def test_ratio_pairs_add_up(spark):
    r = catalog.session_ratio_stats(spark, BASE).first()
    assert abs(r.visit_length_le_10s_ratio + r.visit_length_gt_10s_ratio - 100) <= 0.01
    assert abs(r.step_length_le_5_ratio + r.step_length_gt_5_ratio - 100) <= 0.01


def test_sample_bounded_and_without_repeats(spark):
    s = catalog.session_sample(spark, BASE)
    n, distinct = s.agg(F.count(F.lit(1)), F.countDistinct("session_id")).first()
    assert n == distinct <= 1000


def test_hops_bounded_by_source_visits(spark):
    visits = {r.page_id: r.n for r in catalog.page_visit_counts(spark, BASE).collect()}
    for r in catalog.page_jump_counts(spark, BASE).collect():
        assert r.n <= visits[int(r.page_jump.split("_")[0])]


def test_city_shares_add_up(spark):
    for r in catalog.area_city_remark(spark, BASE).collect():
        shares = [float(p.rsplit(":", 1)[1].rstrip("%")) for p in r.city_remark.split(",")]
        assert abs(sum(shares) - 100) <= 0.1 + 1e-9, r.city_remark


def test_area_sums_equal_event_counts(spark):
    n_events = fx.events(spark, BASE).count()
    assert catalog.ads_area_daily(spark, BASE).agg(F.sum("n")).first()[0] == n_events
    clicks = fx.user_visit_action(spark, BASE).filter("click_product_id > 0").count()
    assert catalog.area_product_clicks(spark, BASE).agg(F.sum("clickcount")).first()[0] == clicks


def test_kept_plus_dropped_is_all(spark):
    log = catalog._ads_log(spark, BASE)
    kept = catalog.ads_kept_events(spark, BASE).count()
    listed = catalog.ads_blacklist(spark, BASE).count()
    assert kept <= log.count() and listed > 0
    # users never listed keep every event
    free = log.join(catalog.ads_blacklist(spark, BASE), "user_id", "left_anti").count()
    assert free <= kept


def remark_text(counts, n=2, other="其他"):
    """Brute force: half-up shares, share desc then name, top n, then the rest of 100."""
    total = float(sum(counts.values()))
    rated = sorted((-math.floor(c / total * 1000.0 + 0.5) / 10.0, name) for name, c in counts.items())
    parts = [f"{name}:{-neg!r}%" for neg, name in rated[:n]]
    if len(rated) > n:
        rest = 100.0
        for neg, _ in rated[:n]:
            rest += neg
        parts.append(f"{other}:{math.floor(rest * 10.0 + 0.5) / 10.0!r}%")
    return ",".join(parts)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from(["A", "B", "C_1", "D", "E", "F"]), st.integers(1, 40),
                       min_size=1, max_size=6))
def test_city_remark_builtin_equals_python(spark, counts):
    df = spark.createDataFrame([(c, n) for c, n in counts.items()], "city_name string, c long")
    g = df.agg(F.sum("c").alias("total"), F.collect_list(F.struct("c", "city_name")).alias("cities"))
    builtin = g.select(areas.city_remark("cities", "total").alias("r")).first().r
    from shopflow.functions.city_remark import register_city_remark
    register_city_remark(spark)
    in_sql = g.selectExpr("groupby_city_count(cities) AS r").first().r
    assert builtin == in_sql == remark_text(counts)


@pytest.mark.parametrize("name", ["session_info", "page_jump_counts"])
def test_chunk_size_does_not_change_results(spark, name):
    from shopflow.operators import funnel, sessions
    acts = catalog._actions(spark, BASE)
    if name == "session_info":
        a, b = sessions.session_info(acts, 60), sessions.session_info(acts, 86400)
    else:
        a, b = funnel.page_jump_counts(acts, catalog.FLOW, 60), funnel.page_jump_counts(acts, catalog.FLOW, 86400)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
