"""Sliding windows on a stream by panes (T8): equal to a copy per window, in state rows and in plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shopflow.operators import ads
from shopflow.streaming import ads_stream

SCHEMA = "ts timestamp, area string, city string, user_id string, ads_id string, seq long"


def slices(spark, path, batches):
    """A stream that reads ``batches`` (lists of (seconds, ad)) as one micro-batch each."""
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [[(t0 + dt.timedelta(seconds=s), "A", "c", "u", ad, i) for i, (s, ad) in enumerate(b)] for b in batches]
    for k, r in enumerate(rows):
        spark.createDataFrame(r, SCHEMA).coalesce(1).write.parquet(f"{path}/in/b{k}")
    return spark.createDataFrame([r for b in rows for r in b], SCHEMA)


def stream(spark, path, k):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/b[0-{k}]")


def as_map(df):
    rows = df.collect()
    out = {(r.window_start, r.window_end, r.ads_id): r.n for r in rows}
    assert len(out) == len(rows)
    return out


def native(log, size, slide):
    return {(r.w.start, r.w.end, r.ads_id): r["count"] for r in
            log.groupBy(F.window("ts", size, slide).alias("w"), "ads_id").count().collect()}


@pytest.mark.parametrize("size,slide", [("60 minutes", "10 seconds"), ("10 minutes", "2 minutes")])
def test_panes_equal_a_copy_per_window_after_every_batch(spark, tmp_root, size, slide):
    rnd = random.Random(2)
    batches = [[(2400 * k + rnd.randrange(0, 2700), str(rnd.randrange(2))) for _ in range(40)] for k in range(3)]
    slices(spark, tmp_root, batches)
    for k in range(len(batches)):  # resumed from its checkpoint each time
        ads_stream.run_available(ads_stream.start_sliding_counts(
            stream(spark, tmp_root, k), tmp_root, size, slide, trigger={"availableNow": True}, state_partitions=1))
        seen = spark.read.schema(SCHEMA).parquet(*[f"{tmp_root}/in/b{i}" for i in range(k + 1)])
        assert as_map(ads_stream.sliding_counts_so_far(spark, tmp_root, size, slide)) == native(seen, size, slide)
    # Windows end up in the sink once closed, and state holds open panes and windows only.
    newest = max(s for b in batches for s, _ in b)
    closed = spark.read.parquet(f"{tmp_root}/sliding")
    mark = dt.datetime(2024, 1, 1, 10) + dt.timedelta(seconds=newest - 3600)
    want = {k for k in native(seen, size, slide) if k[1] <= mark}
    got = {(r.window_start, r.window_end, r.ads_id) for r in closed.collect()}
    assert got == want
    size_s, slide_s = ads._seconds(size), ads._seconds(slide)
    for op in (0, 1):
        most = 2 * (3600 // slide_s + 2) if "count" in ads_stream.state_rows(spark, tmp_root, op).schema["value"].dataType.names \
            else 2 * ((3600 + size_s) // slide_s + 2)
        assert ads_stream.state_rows(spark, tmp_root, op).count() <= most


def test_an_event_is_one_row_until_its_pane_is_counted(spark, tmp_root):
    log = slices(spark, tmp_root, [[(i % 5, "1") for i in range(500)]])  # 500 events, one pane
    expanded = {}
    for name, df in (("panes", ads.sliding_counts(stream(spark, tmp_root, 0).withWatermark("ts", "1 hour"), "60 minutes", "10 seconds")),
                     ("copies", stream(spark, tmp_root, 0).withWatermark("ts", "1 hour").groupBy(
                         F.window("ts", "60 minutes", "10 seconds").alias("w"), "ads_id").count())):
        q = df.writeStream.outputMode("append").format("noop").option("checkpointLocation", f"{tmp_root}/{name}") \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        expanded[name] = sum(op.numRowsUpdated for p in q.recentProgress for op in p.stateOperators)
    assert expanded["panes"] == 1          # the pane of 500 events is one state row
    assert expanded["copies"] == 360       # a state row for each window over it
    assert log.count() == 500
