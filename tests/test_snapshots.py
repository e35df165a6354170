"""The snapshot store keeps every row whatever a crash leaves behind, and its listing stays bounded."""

import pytest

from shopflow.operators import funnel
from shopflow.sources import sinks
from shopflow.streaming import ads_stream


def _store(spark, root):
    return sinks.SnapshotStore(spark, f"{root}/s", ["k"], "k long, v long")


def _put(spark, store, b, rows):
    store.write_batch(spark.createDataFrame(rows, "k long, v long"), b)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_unfinished_and_repeated_compaction(spark, tmp_root, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        s = _store(spark, tmp_root)
        _put(spark, s, 0, [(1, 10), (2, 20)])
        _put(spark, s, 1, [(2, 21)])
        spark.range(0).selectExpr("id k", "id v").write.parquet(f"{s.full_path}/batch_id=1")
        sinks.remove(spark, f"{s.full_path}/batch_id=1/_SUCCESS")  # what a crash leaves: no commit
        want = [(1, 10), (2, 21)]
        assert _rows(s.read()) == want
        for _ in range(3):  # the batch runs again
            s.compact(1)
            assert _rows(s.read()) == want
        spark.range(0).selectExpr("id k", "id v").write.parquet(f"{s.path}/batch_id=2")
        sinks.remove(spark, f"{s.path}/batch_id=2/_SUCCESS")
        assert _rows(s.read()) == want and _rows(s.read_latest()) == [(2, 21)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_listing_stays_bounded(spark, tmp_root):
    s = _store(spark, tmp_root)
    for b in range(20):
        _put(spark, s, b, [(b % 4, b)])
        if b % 5 == 4:
            s.compact(b)
    assert _rows(s.read()) == [(0, 16), (1, 17), (2, 18), (3, 19)]
    assert len(sinks.batch_ids(spark, s.path)) <= 10 and len(sinks.batch_ids(spark, s.full_path)) <= 2


def test_short_watermark_is_refused(spark):
    log = spark.createDataFrame([], "ts timestamp, ads_id long")
    with pytest.raises(ValueError):
        ads_stream.start_last_hour(log, "/unused", minutes=180, watermark="60 minutes")


def test_repeated_hop_is_listed_once():
    assert funnel.flow_jumps("1,2,1,2") == ["1_2", "2_1"]
