"""Stream = batch, restart from checkpoint, and the per-batch blacklist rule."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopflow.operators import ads
from shopflow.sources import fixtures as fx
from shopflow.sources.sinks import SnapshotStore
from shopflow.streaming import ads_stream

from conftest import SF_SMALL


def _write_line_files(spark, lines, folder, n_files):
    """Ad lines ordered by time, split into ``n_files`` text files (one micro-batch each)."""
    ordered = lines.withColumn("_ms", F.split("value", " ").getItem(0).cast("long"))
    ordered = ordered.withColumn("_part", F.ntile(n_files).over(Window.orderBy("_ms", "value")))
    rows = ordered.orderBy("_ms", "value").select("_part", "value").collect()  # test data: 1000 rows
    os.makedirs(folder, exist_ok=True)
    for p in range(1, n_files + 1):
        path = os.path.join(folder, f"part-{p:03d}.txt")
        with open(path, "w") as f:
            f.writelines(r.value + "\n" for r in rows if r._part == p)
        # The file source takes files in modification-time order; files written within the
        # same millisecond would tie, so give them strictly increasing times (time order).
        os.utime(path, (1_700_000_000 + p, 1_700_000_000 + p))


def _in_order(folder, names):
    """Strictly increasing modification times, so the file source reads them in this order."""
    for i, name in enumerate(names, 1):
        os.utime(os.path.join(folder, name), (1_700_000_000 + i, 1_700_000_000 + i))


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _batch_log(spark, folder):
    lines = spark.read.text(folder).select("value", F.xxhash64("value").alias("seq"))
    return ads.parse_ads_log(lines)


def _set(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def lines(spark):
    from shopflow.session import prepare
    prepare(spark)
    return fx.ads_lines(spark, SF_SMALL)


@pytest.mark.parametrize("n_files", [1, 3, 7])
def test_daily_totals_stream_equals_batch(spark, lines, tmp_root, n_files):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, n_files)
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    q = ads_stream.start_area_city_daily(log, tmp_root, trigger={"availableNow": True})
    ads_stream.run_available(q)
    got = ads_stream.daily_totals(spark, tmp_root)
    cols = ["day", "area", "city", "ads_id", "n"]
    batch = ads.area_city_daily(_batch_log(spark, src))
    assert _set(got, cols) == _set(batch, cols)
    top = ads_stream.daily_top(spark, tmp_root)
    tcols = ["day", "area", "ads_id", "n", "rn"]
    assert _set(top, tcols) == _set(ads.area_top_ads(batch), tcols)


def test_daily_totals_restart_from_checkpoint(spark, lines, tmp_root):
    src = _local(f"{tmp_root}/src")
    staging = _local(f"{tmp_root}/staging")
    _write_line_files(spark, lines, staging, 4)
    os.makedirs(src)
    names = sorted(os.listdir(staging))
    for name in names[:2]:  # first run sees half the files
        with open(os.path.join(staging, name)) as a, open(os.path.join(src, name), "w") as b:
            b.write(a.read())
    run = lambda: ads_stream.run_available(ads_stream.start_area_city_daily(
        ads.parse_ads_log(ads_stream.text_lines(spark, src, 1)), tmp_root, trigger={"availableNow": True}))
    run()
    for name in names[2:]:
        with open(os.path.join(staging, name)) as a, open(os.path.join(src, name), "w") as b:
            b.write(a.read())
    run()  # resumes from the checkpoint: only the new files are read, state carries the totals
    got = ads_stream.daily_totals(spark, tmp_root)
    cols = ["day", "area", "city", "ads_id", "n"]
    assert _set(got, cols) == _set(ads.area_city_daily(_batch_log(spark, src)), cols)


@pytest.mark.parametrize("n_files", [1, 3])
def test_last_hour_stream_equals_batch(spark, lines, tmp_root, n_files):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, n_files)
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_last_hour(log, tmp_root, trigger={"availableNow": True}))
    got = ads_stream.last_hour_store(spark, tmp_root).read_latest()
    cols = ["ads_id", "minute", "n"]
    assert _set(got, cols) == _set(ads.last_hour(_batch_log(spark, src)), cols)


def test_g13_blacklist_per_batch(spark, tmp_root):
    src = _local(f"{tmp_root}/src")
    os.makedirs(src)
    t0 = int(dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    with open(os.path.join(src, "b1.txt"), "w") as f:
        f.writelines(f"{t0 + i} A c u 1\n" for i in range(3))
        f.write(f"{t0} A c v 1\n")
    with open(os.path.join(src, "b2.txt"), "w") as f:
        f.write(f"{t0 + 10} A c u 1\n")
        f.write(f"{t0 + 11} A c v 2\n")
    _in_order(src, ["b1.txt", "b2.txt"])
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_blacklist(log, tmp_root, threshold=2, keep_events=True,
                                                        trigger={"availableNow": True}))
    listed = ads_stream.blacklist_store(spark, tmp_root).read()
    assert [r.user_id for r in listed.collect()] == ["u"]
    kept = spark.read.parquet(f"{tmp_root}/kept")
    per_batch = sorted((r.batch_id, r.user_id) for r in kept.collect())
    assert per_batch == [(0, "u"), (0, "u"), (0, "u"), (0, "v"), (1, "v")]
    totals = ads_stream.user_daily_store(spark, tmp_root).read()
    assert _set(totals, ["user_id", "ads_id", "n"]) == [("u", "1", 3), ("v", "1", 1), ("v", "2", 1)]


def test_snapshot_store_idempotent_and_compact(spark, tmp_root):
    store = SnapshotStore(spark, f"{tmp_root}/kv", ["k"], "k string, v long")
    assert store.read().count() == 0
    mk = lambda rows: spark.createDataFrame(rows, "k string, v long")
    store.write_batch(mk([("a", 1), ("b", 1)]), 0)
    store.write_batch(mk([("a", 2)]), 1)
    store.write_batch(mk([("a", 2)]), 1)  # the same batch again after a failure
    assert _set(store.read(), ["k", "v"]) == [("a", 2), ("b", 1)]
    assert _set(store.read(before=1), ["k", "v"]) == [("a", 1), ("b", 1)]
    store.compact(1)
    store.write_batch(mk([("b", 5)]), 2)
    assert _set(store.read(), ["k", "v"]) == [("a", 2), ("b", 5)]
    assert _set(store.read_latest(), ["k", "v"]) == [("b", 5)]


def _daily(spark, src, root, **options):
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_area_city_daily(log, root, trigger={"availableNow": True}, **options))


TOTAL_COLS, TOP_COLS = ["day", "area", "city", "ads_id", "n"], ["day", "area", "ads_id", "n", "rn"]


def test_daily_totals_live_in_state_alone(spark, lines, tmp_root):
    """The totals are written nowhere but in the checkpoint; the lists hold their days' newest form only."""
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, 5)
    _daily(spark, src, tmp_root)
    assert sorted(d for d in os.listdir(_local(tmp_root)) if d != "src") == ["checkpoint", "top", "top_json"]
    batch = ads.area_city_daily(_batch_log(spark, src))
    assert _set(ads_stream.daily_totals(spark, tmp_root), TOTAL_COLS) == _set(batch, TOTAL_COLS)
    top = ads.area_top_ads(batch)
    assert _set(ads_stream.daily_top(spark, tmp_root), TOP_COLS) == _set(top, TOP_COLS)
    json_cols = ["date_key", "area", "top3_json"]
    assert _set(ads_stream.daily_top_json(spark, tmp_root), json_cols) == _set(ads.area_top_ads_json(top), json_cols)


def test_top_lists_survive_a_broken_replacement(spark, tmp_root):
    """A run that broke off after a day's old list was deleted: the next start takes it from the state."""
    src = _local(f"{tmp_root}/src")
    os.makedirs(src)
    t0 = int(dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i, clicks in enumerate((["1"] * 5 + ["2"] * 4 + ["3"] * 3 + ["4"] * 2, ["4"] * 2 + ["5"]), 1):
        with open(os.path.join(src, f"b{i}.txt"), "w") as f:
            f.writelines(f"{t0 + 1000 * i + k} A c{k % 2} u {ad}\n" for k, ad in enumerate(clicks))
        _in_order(src, [f"b{j}.txt" for j in range(1, i + 1)])
        if i == 2:
            day = _local(f"{tmp_root}/top/day=2024-01-01")
            for name in os.listdir(day):
                os.remove(os.path.join(day, name))
        _daily(spark, src, tmp_root)
    want = [(1, "1", 5), (2, "2", 4), (3, "4", 4)]
    assert _set(ads_stream.daily_top(spark, tmp_root), ["rn", "ads_id", "n"]) == want
    assert _set(ads.area_top_ads(ads.area_city_daily(_batch_log(spark, src))), ["rn", "ads_id", "n"]) == want


def test_watermark_closes_days(spark, tmp_root):
    """Closed days leave the state and stay in totals and lists."""
    src = _local(f"{tmp_root}/src")
    os.makedirs(src)
    t0 = int(dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i in range(1, 6):
        with open(os.path.join(src, f"b{i}.txt"), "w") as f:
            f.writelines(f"{t0 + 86400000 * (i - 1) + k} A c{k % 2} u {k % 3}\n" for k in range(20 + i))
    _in_order(src, [f"b{i}.txt" for i in range(1, 6)])
    _daily(spark, src, tmp_root, watermark="1 day")
    days = {r.day for r in ads_stream._state_totals(spark, tmp_root).select("day").distinct().collect()}
    assert days == {"2024-01-04", "2024-01-05"}
    batch = ads.area_city_daily(_batch_log(spark, src))
    assert _set(ads_stream.daily_totals(spark, tmp_root), TOTAL_COLS) == _set(batch, TOTAL_COLS)
    assert _set(ads_stream.daily_top(spark, tmp_root), TOP_COLS) == _set(ads.area_top_ads(batch), TOP_COLS)


def _start_per_event(log, root, threshold):
    return ads_stream.start_blacklist(log, root, threshold=threshold, rule="per_event", keep_events=True,
                                      trigger={"availableNow": True})


@pytest.mark.parametrize("n_files", [1, 4])
def test_blacklist_per_event_stream_equals_batch(spark, lines, tmp_root, n_files):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, n_files)
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(_start_per_event(log, tmp_root, 3))
    batch_log = _batch_log(spark, src)
    cols = ["ts", "area", "city", "user_id", "ads_id", "seq"]
    kept = ads_stream.kept_events_store(spark, tmp_root).read_all()
    assert _set(kept, cols) == _set(ads.kept_events(batch_log, 3), cols)
    listed = ads_stream.blacklist_store(spark, tmp_root).read()
    assert _set(listed, ["user_id"]) == _set(ads.blacklist(batch_log, 3), ["user_id"])


def test_last_hour_json_stream_and_trigger_clock(spark, lines, tmp_root):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, 2)
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_last_hour(log, tmp_root, trigger={"availableNow": True}))
    got = ads_stream.last_hour_json_store(spark, tmp_root).read_latest()
    want = ads.last_hour_json(ads.last_hour(_batch_log(spark, src)))
    assert _set(got, ["ads_id", "series_json"]) == _set(want, ["ads_id", "series_json"])
    # Wall-clock "as of": the test events are from 2024, so nothing is in the last hour now.
    live = f"{tmp_root}/live"
    log2 = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_last_hour(log2, live, trigger={"availableNow": True},
                                                        as_of="trigger"))
    assert ads_stream.last_hour_store(spark, live).read_latest().count() == 0


def test_per_event_counts_carry_across_batches(spark, tmp_root):
    src = _local(f"{tmp_root}/src")
    os.makedirs(src)
    t0 = int(dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    with open(os.path.join(src, "b1.txt"), "w") as f:
        f.write(f"{t0} A c u 1\n{t0 + 1} A c u 1\n{t0 + 2} A c u 2\n")
    with open(os.path.join(src, "b2.txt"), "w") as f:
        f.write(f"{t0 + 10} A c u 1\n{t0 + 11} A c u 1\n{t0 + 12} A c u 2\n")
    _in_order(src, ["b1.txt", "b2.txt"])
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(_start_per_event(log, tmp_root, 3))
    kept = ads_stream.kept_events_store(spark, tmp_root).read_all()
    got = sorted((r.ads_id, r.ts.second, r.ts.microsecond // 1000) for r in kept.collect())
    # the third click on ad 1 (first of batch 2) lists u; later events are dropped
    assert got == [("1", 0, 0), ("1", 0, 1), ("1", 0, 10), ("2", 0, 2)]
    assert [r.user_id for r in ads_stream.blacklist_store(spark, tmp_root).read().collect()] == ["u"]


def test_daily_totals_with_watermark_equals_batch(spark, lines, tmp_root):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, 3)
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_area_city_daily(log, tmp_root, trigger={"availableNow": True},
                                                              watermark="2 days"))
    cols = ["day", "area", "city", "ads_id", "n"]
    got = ads_stream.daily_totals(spark, tmp_root)
    assert _set(got, cols) == _set(ads.area_city_daily(_batch_log(spark, src)), cols)


def test_state_partitions_do_not_leak_into_the_session(spark, lines, tmp_root):
    src = _local(f"{tmp_root}/src")
    _write_line_files(spark, lines, src, 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src))
    ads_stream.run_available(ads_stream.start_area_city_daily(log, tmp_root, trigger={"availableNow": True},
                                                              state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = _local(f"{tmp_root}/checkpoint/state/0")
    assert sorted(d for d in os.listdir(state) if d.isdigit()) == ["0", "1", "2"]


def test_last_hour_of_180_minutes_keeps_late_events(spark, tmp_root):
    """An event 92 minutes late but inside the window is counted, as in the batch form."""
    src = _local(f"{tmp_root}/src")
    os.makedirs(src)
    t0 = int(dt.datetime(2024, 1, 1, 12, 32, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i, minute in enumerate([0, 0, -92], 1):
        with open(os.path.join(src, f"b{i}.txt"), "w") as f:
            f.write(f"{t0 + 60000 * minute + i} A c u 1\n")
    _in_order(src, ["b1.txt", "b2.txt", "b3.txt"])
    log = ads.parse_ads_log(ads_stream.text_lines(spark, src, max_files_per_trigger=1))
    ads_stream.run_available(ads_stream.start_last_hour(log, tmp_root, trigger={"availableNow": True}, minutes=180))
    got = ads_stream.last_hour_store(spark, tmp_root).read_latest()
    cols = ["ads_id", "minute", "n"]
    assert _set(got, cols) == _set(ads.last_hour(_batch_log(spark, src), minutes=180), cols)
    assert _set(got, ["hh_mm", "n"]) == [("11:00", 1), ("12:32", 2)]
    with pytest.raises(ValueError):
        ads_stream.start_last_hour(log, tmp_root, minutes=180, watermark="60 minutes")
