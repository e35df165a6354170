"""Structured Streaming wiring of the realtime questions.

Independent streaming queries on the same parsed input, each with its own checkpoint:

* ``start_area_city_daily`` - running clicks per (day, area, city, ad) and per (day, area, ad) in one
  state; totals are read from that state, each micro-batch merges the totals it changed into the
  top lists of its days (R8, R9).
* ``start_blacklist``       - per micro-batch: drop listed users (list re-read every batch),
  count per (day, user, ad), upsert totals, list users whose total reaches the threshold (R7).
* ``start_sliding_counts``  - clicks per sliding window and ad with a watermark (T8).
* ``start_last_hour``       - clicks per (ad, minute) with a watermark, then the last 60 minutes
  per trigger, replacing the previous result (R10).

Totals and minute counts live in Spark's state only and are read with Spark's state reader. Top lists
replace their day's partition; the other writes go through ``SnapshotStore`` (idempotent per batch
id). All state lies under the folders the caller names (normally below ``spark.checkpoint.dir``), so
a restarted query resumes from its checkpoint with the same totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators import ads
from shopflow.sources import fixtures as fx
from shopflow.sources.sinks import SnapshotStore

TOTALS_SCHEMA = "day string, area string, city string, ads_id string, n long"
TOP_SCHEMA = "day string, area string, rn long, ads_id string, n long"
TOP_JSON_SCHEMA = "date_key string, area string, top3_json string"
USER_DAILY_SCHEMA = "day string, user_id string, ads_id string, n long"
BLACKLIST_SCHEMA = "user_id string"
LAST_HOUR_SCHEMA = "ads_id string, minute string, hh_mm string, n long"


# ---------------------------------------------------------------- result stores (readers use these)
def user_daily_store(spark: SparkSession, root: str) -> SnapshotStore:
    return SnapshotStore(spark, f"{root}/user_daily", ["day", "user_id", "ads_id"], USER_DAILY_SCHEMA,
                         partition_by=["day"])


def blacklist_store(spark: SparkSession, root: str) -> SnapshotStore:
    return SnapshotStore(spark, f"{root}/blacklist", ["user_id"], BLACKLIST_SCHEMA)


def last_hour_json_store(spark: SparkSession, root: str) -> SnapshotStore:
    return SnapshotStore(spark, f"{root}/last_hour_json", ["ads_id"], "ads_id string, series_json string")


def kept_events_store(spark: SparkSession, root: str) -> SnapshotStore:
    """Events that passed the blacklist, one folder per batch (read all of them)."""
    return SnapshotStore(spark, f"{root}/kept", ["seq"],
                         "ts timestamp, area string, city string, user_id string, ads_id string, "
                         "seq long, day string")


def last_hour_store(spark: SparkSession, root: str) -> SnapshotStore:
    return SnapshotStore(spark, f"{root}/last_hour", ["ads_id", "minute"], LAST_HOUR_SCHEMA)


def rejects_store(spark: SparkSession, root: str) -> SnapshotStore:
    return SnapshotStore(spark, f"{root}/rejects", ["seq"], "value string, reason string, seq long")


# ---------------------------------------------------------------- sources (S3)
def kafka_lines(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                max_offsets_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Lines from a Kafka topic (value as text) with a unique ``seq`` from (partition, offset).
    ``max_offsets_per_trigger`` bounds a micro-batch, and with it every per-batch group.
    Needs the Kafka connector on the classpath."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load()
    seq = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return df.select(F.col("value").cast("string").alias("value"), seq.alias("seq"))


def text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines from text files arriving in a folder; ``seq`` is a hash of the line (identical lines
    are interchangeable, so this is enough to order events of the same millisecond)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("value", F.xxhash64("value").alias("seq"))


def event_lines(spark: SparkSession, base: str, max_files_per_trigger: int | None = None,
                pattern: str = "events.parq*") -> DataFrame:
    """The test ``events`` table read as a stream and turned into ad-click lines."""
    schema = spark.read.parquet(f"{base.rstrip('/')}/events.parquet").schema
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.load(f"{base.rstrip('/')}/{pattern}")
    return fx.ads_lines(spark, base, events_df=stream)


def of_batch_days(store: SnapshotStore, batch: DataFrame, before: int) -> DataFrame:
    """Rows of a day-partitioned store for the days of a (persisted) micro-batch. First and last day
    prune the folders; a semi join keeps the days in between that the batch holds."""
    first, last = batch.agg(F.min("day"), F.max("day")).first()
    span = F.col("day").between(first, last) if first is not None else F.lit(False)
    return store.read(before=before, where=span, only=batch.select("day").filter(span).distinct())


def _start(writer, spark: SparkSession, trigger: dict | None, state_partitions: int | None):
    """Start a query. T1: the reference used 5 s micro-batches; tests use availableNow.

    ``state_partitions`` sets the shuffle (and state-store) partitions of a query started on a
    new checkpoint - a stream keeps the number it started with - without changing the caller's
    session: the query runs on a copy of the session conf taken at start."""
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if state_partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


# ---------------------------------------------------------------- R8 + R9
def state_rows(spark: SparkSession, root: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(key, value) of one stateful operator of a stream, as its last batch (or ``batch``) left them, by
    Spark's own reader of state over the checkpoint."""
    r = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        r = r.option("batchId", batch)
    return r.load(f"{root}/checkpoint").select("key", "value")


AREA_LEVEL = 2  # grouping id of (day, area, ads_id): the bit of city alone is set


def start_area_city_daily(log: DataFrame, root: str, trigger: dict | None = None,
                          watermark: str | None = None, top_n: int = 3,
                          state_partitions: int | None = None) -> StreamingQuery:
    """Running totals per (day, area, city, ad) and the top ``top_n`` ads per (day, area).

    The totals live in the state store alone, per city and, as a second grouping set, per area; read
    them with :func:`daily_totals`. Totals only grow, so a day's new top list is the top of its old
    list and of the ads the batch touched: a batch reads neither the totals nor the history. The
    lists replace their day's partition of ``{root}/top`` and ``{root}/top_json``
    (:func:`daily_top`, :func:`daily_top_json`). The first batch after a start takes the old lists from
    the state that the batch before it committed, so a run that broke off while it replaced a
    partition leaves no gap; merging the same batch twice changes nothing.

    Without ``watermark`` the state keeps every key, as the reference did (keys are
    days x areas x cities x ads, so it grows by day, not by event). With one, days that the watermark
    has closed leave the state: Spark's file sink writes them once to ``{root}/days``, and totals and
    lists are both made when read, from closed days and the state.
    """
    spark = log.sparkSession
    if watermark:
        src = log.withWatermark("ts", watermark).groupBy(F.window("ts", "1 day"), "area", "city", "ads_id").count()
        closed = src.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "area", "city", "ads_id",
                            F.col("count").alias("n"))
        w = closed.writeStream.outputMode("append").format("parquet").option("path", f"{root}/days") \
            .option("checkpointLocation", f"{root}/checkpoint")
        return _start(w, spark, trigger, state_partitions)

    city, area = ["day", "area", "city", "ads_id"], ["day", "area", "ads_id"]
    counts = ads.with_day(log).groupingSets([city, area], *city).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"))
    for name, schema, key in (("top", TOP_SCHEMA, "day"), ("top_json", TOP_JSON_SCHEMA, "date_key")):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(key).parquet(f"{root}/{name}")
    resumed = []

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        touched = batch.filter(F.col("level") == AREA_LEVEL).select(*area, "n").persist()
        ranked = None
        try:
            first, last = touched.agg(F.min("day"), F.max("day")).first()
            if first is not None:
                if resumed:
                    old = session.read.schema(TOP_SCHEMA).parquet(f"{root}/top").select(*area, "n")
                else:
                    old = _state_totals(session, root, AREA_LEVEL, batch_id - 1).select(*area, "n") if batch_id else touched
                old = old.filter(F.col("day").between(first, last)) \
                    .join(touched.select("day").distinct(), "day", "left_semi")
                newest = old.unionByName(touched).groupBy(*area).agg(F.max("n").alias("n"))
                ranked = ads.area_top_ads(newest, top_n, rolled=True).persist()
                _replace_parts(ranked.select("area", "rn", "ads_id", "n", "day"), f"{root}/top", "day")
                _replace_parts(ads.area_top_ads_json(ranked), f"{root}/top_json", "date_key")
                resumed[:] = [batch_id]
        finally:
            touched.unpersist()
            if ranked is not None:
                ranked.unpersist()

    w = counts.writeStream.outputMode("update").foreachBatch(process) \
        .option("checkpointLocation", f"{root}/checkpoint")
    return _start(w, spark, trigger, state_partitions)


def _replace_parts(df: DataFrame, path: str, key: str) -> None:
    """Replace the partitions of ``path`` that ``df`` holds, leaving all others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def _state_totals(spark: SparkSession, root: str, level: int = 0, batch: int | None = None) -> DataFrame:
    """Totals in the daily stream's state: per city (level 0) or per area, where ``city`` is null."""
    rows = state_rows(spark, root, batch=batch)
    fields = rows.schema["key"].dataType.names
    if "window" in fields:
        rows = rows.withColumn("day", F.date_format("key.window.start", "yyyy-MM-dd"))
    else:
        rows = rows.filter(F.col("key.spark_grouping_id") == level).withColumn("day", F.col("key.day"))
    return rows.select("day", "key.area", "key.city", "key.ads_id", F.col("value.count").alias("n"))


def _closes_days(spark: SparkSession, root: str) -> bool:
    return "window" in state_rows(spark, root).schema["key"].dataType.names


def daily_totals(spark: SparkSession, root: str) -> DataFrame:
    """Clicks per (day, area, city, ad) up to the last batch of :func:`start_area_city_daily`, from its state
    and, where it was given a watermark, the days closed before."""
    still = _state_totals(spark, root)
    if not _closes_days(spark, root):
        return still
    return spark.read.schema(TOTALS_SCHEMA).parquet(f"{root}/days").unionByName(still)


def daily_top(spark: SparkSession, root: str, top_n: int = 3) -> DataFrame:
    """Top ads per (day, area) up to the last batch; ``top_n`` counts where lists are made when read."""
    if _closes_days(spark, root):
        return ads.area_top_ads(daily_totals(spark, root), top_n).select("day", "area", "rn", "ads_id", "n")
    return spark.read.schema(TOP_SCHEMA).parquet(f"{root}/top")


def daily_top_json(spark: SparkSession, root: str, top_n: int = 3) -> DataFrame:
    """Per (day, area) the top list as JSON, keyed like the reference's ``area_top3_ads:<day>``."""
    if _closes_days(spark, root):
        return ads.area_top_ads_json(daily_top(spark, root, top_n))
    return spark.read.schema(TOP_JSON_SCHEMA).parquet(f"{root}/top_json")


# ---------------------------------------------------------------- R7
KEYS = ads.GROUP


def start_blacklist(log: DataFrame, root: str, threshold: int = ads.BLACKLIST_THRESHOLD,
                    trigger: dict | None = None, keep_events: bool = False,
                    compact_every: int = 100, rule: str = "per_batch",
                    state_partitions: int | None = None) -> StreamingQuery:
    """Blacklist on a stream (T5, T6, T10, F6). At every batch the list is re-read, events of
    listed users are dropped, the rest counted per (day, user, ad) and added to the totals; a
    user whose total reaches ``threshold`` is listed for good (all ads and days).

    ``rule="per_batch"`` (the reference's behaviour): a user listed in a batch is dropped from
    the next batch on, so all of that batch's events pass. ``rule="per_event"``: events of a
    user after the one that reaches the threshold are dropped already in that batch, which
    gives the batch ``ads.kept_events`` result whatever the batch boundaries (for events that
    arrive in time order). Both run on DataFrames only; totals count passed events only.
    Results: ``{root}/user_daily``, ``{root}/blacklist`` (and passed events per batch in
    ``{root}/kept`` when ``keep_events``)."""
    if rule not in ("per_batch", "per_event"):
        raise ValueError("rule is 'per_batch' or 'per_event'")
    spark = log.sparkSession
    totals = user_daily_store(spark, root)
    listed = blacklist_store(spark, root)
    kept_store = kept_events_store(spark, root)

    def process(batch: DataFrame, batch_id: int) -> None:
        cached = []

        def keep(df: DataFrame) -> DataFrame:
            cached.append(df.persist())  # T11: read once, used by several outputs
            return df

        try:
            black = listed.read(before=batch_id)
            fresh = keep(ads.with_day(batch).join(black, "user_id", "left_anti"))
            counts = keep(fresh.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))
            prev = keep(of_batch_days(totals, counts, batch_id).withColumnRenamed("n", "prev"))
            if rule == "per_event":
                cut = (ads.threshold_events(fresh, threshold, prev)
                       .groupBy("user_id").agg(F.min(F.struct("ts", "seq")).alias("cut")))
                kept = keep(fresh.join(cut, "user_id", "left")
                            .filter(F.col("cut").isNull() | (F.struct("ts", "seq") <= F.col("cut")))
                            .drop("cut"))
                counts = kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
            else:
                kept = fresh
            merged = keep(counts.join(prev, KEYS, "left")
                          .select(*KEYS, (F.col("n") + F.coalesce(F.col("prev"), F.lit(0))).alias("n")))
            totals.write_batch(merged, batch_id)
            listed.write_batch(merged.filter(F.col("n") >= threshold).select("user_id").distinct(),
                               batch_id)
            if keep_events:
                kept_store.write_batch(kept, batch_id)
            if compact_every and batch_id > 0 and batch_id % compact_every == 0:
                totals.compact(batch_id)
                listed.compact(batch_id)
        finally:
            for df in cached:
                df.unpersist()

    w = log.writeStream.foreachBatch(process).option("checkpointLocation", f"{root}/checkpoint")
    return _start(w, spark, trigger, state_partitions)


# ---------------------------------------------------------------- rejected lines
def start_rejects(rejected: DataFrame, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Lines that do not parse, with their reason, one folder per batch (``{root}/rejects``)."""
    store = rejects_store(rejected.sparkSession, root)
    w = (rejected.writeStream.foreachBatch(lambda batch, batch_id: store.write_batch(batch, batch_id))
         .option("checkpointLocation", f"{root}/checkpoint"))
    return _start(w, rejected.sparkSession, trigger, None)


# ---------------------------------------------------------------- T8
def start_sliding_counts(log: DataFrame, root: str, size: str = "60 minutes", slide: str = "10 minutes",
                         watermark: str = "60 minutes", trigger: dict | None = None,
                         state_partitions: int | None = None) -> StreamingQuery:
    """Clicks per (sliding window, ad) of event time (T8). Events are counted per slide-long pane in one
    state; a pane that the watermark has closed adds its count to the windows it is part of in a second
    state, so an event is one row whatever the number of windows over it (360 at 60 minutes / 10 seconds).
    A window is written once, when the watermark passes its end, by Spark's file sink (append mode) to
    ``{root}/sliding``; :func:`sliding_counts_so_far` adds the windows still open. Events later than
    ``watermark`` after the newest one are dropped for panes that have closed, as Spark's watermarks do."""
    counts = ads.sliding_counts(log.withWatermark("ts", watermark), size, slide)
    w = counts.writeStream.outputMode("append").format("parquet").option("path", f"{root}/sliding") \
        .option("checkpointLocation", f"{root}/checkpoint")
    return _start(w, log.sparkSession, trigger, state_partitions)


def sliding_counts_so_far(spark: SparkSession, root: str, size: str = "60 minutes", slide: str = "10 minutes") -> DataFrame:
    """All windows of :func:`start_sliding_counts` up to its last batch: closed ones from the sink, open ones
    from the stream's state (sums of closed panes, and panes still counted)."""
    names = ["window_start", "window_end", "ads_id", "n"]
    closed = spark.read.schema("window_start timestamp, window_end timestamp, ads_id string, n long") \
        .parquet(f"{root}/sliding").select(*names)
    # Told apart by what they hold, not by the order in which Spark numbers them.
    states = {s.schema["value"].dataType.names[0]: s for s in (state_rows(spark, root, k) for k in (0, 1))}
    panes = states["count"].select(F.unix_millis("key.window.start").alias("pane_ms"), "key.ads_id",
                                   F.col("value.count").alias("c"))
    sums = states["sum"].select(F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
                                "key.ads_id", F.col("value.sum").alias("n"))
    still = sums.unionByName(ads.windows_of_panes(panes, size, slide)).groupBy(*names[:3]).agg(F.sum("n").alias("n"))
    return closed.unionByName(still.select(*names))


# ---------------------------------------------------------------- R10
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(interval: str) -> float:
    """Seconds of a watermark such as ``90 minutes``."""
    n, unit = interval.split()
    return float(n) * _UNIT_SECONDS[unit.rstrip("s")]


def start_last_hour(log: DataFrame, root: str, trigger: dict | None = None,
                    watermark: str | None = None, minutes: int = 60, as_of: str = "newest_event",
                    state_partitions: int | None = None) -> StreamingQuery:
    """Clicks per (ad, minute) for the last ``minutes`` minutes, refreshed every trigger.

    Events are counted once per (ad, minute) in the state store (no copy per sliding window);
    the watermark (``minutes`` unless a longer one is given; a shorter one is refused) evicts minutes
    that can no longer fall in the window. Minute counts live in that state alone: each batch merges
    the counts it changed with those of the state before it (open minutes only) and replaces the
    result with the ``minutes`` minutes ending at ``as_of``: the newest event's minute
    (``"newest_event"``, reproducible) or the trigger's wall-clock minute (``"trigger"``, a live
    dashboard; D17). Results: ``{root}/last_hour`` (rows) and ``{root}/last_hour_json`` (one JSON
    series per ad), both read with ``read_latest``."""
    if as_of not in ("newest_event", "trigger"):
        raise ValueError("as_of is 'newest_event' or 'trigger'")
    spark = log.sparkSession
    watermark = watermark or f"{minutes} minutes"
    if _seconds(watermark) < 60 * minutes:
        raise ValueError(f"a watermark of {watermark} drops events inside the last {minutes} minutes")
    counts = (log.withWatermark("ts", watermark)
              .groupBy("ads_id", F.window("ts", "1 minute").alias("w"))
              .agg(F.count(F.lit(1)).alias("n")))
    result = last_hour_store(spark, root)
    series = last_hour_json_store(spark, root)

    def process(batch: DataFrame, batch_id: int) -> None:
        current = batch.select("ads_id", F.col("w.start").alias("minute_ts"), "n")
        if batch_id:  # counts only grow, so the larger one is the newer
            before = state_rows(batch.sparkSession, root, batch=batch_id - 1).select(
                "key.ads_id", F.col("key.window.start").alias("minute_ts"), F.col("value.count").alias("n"))
            current = current.unionByName(before).groupBy("ads_id", "minute_ts").agg(F.max("n").alias("n"))
        current = current.persist()
        recent = None
        try:
            newest = F.current_timestamp() if as_of == "trigger" else current.select(F.max("minute_ts")).scalar()
            recent = ads.last_hour_from_minutes(ads.last_minutes(current, newest, minutes)).persist()
            result.write_batch(recent, batch_id)
            series.write_batch(ads.last_hour_json(recent), batch_id)
        finally:
            current.unpersist()
            if recent is not None:
                recent.unpersist()

    w = counts.writeStream.outputMode("update").foreachBatch(process) \
        .option("checkpointLocation", f"{root}/checkpoint")
    return _start(w, spark, trigger, state_partitions)


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to drain its input, however long; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def replay(spark: SparkSession, base: str, root: str, start, batches: int = 3) -> None:
    """Feed all test events, in time order and ``batches`` slices, to ``start(log)``: each slice is
    written to the source folder and drained by a run that resumes from the checkpoint."""
    events = fx.events(spark, base)
    cuts = events.agg(F.percentile_approx("ts", [i / batches for i in range(1, batches)], 10000)).first()[0] or []
    slice_no = sum((F.when(F.col("ts") > F.lit(c).cast(events.schema["ts"].dataType), 1).otherwise(0) for c in cuts),
                   F.lit(0))
    for i in range(batches):
        events.filter(F.coalesce(slice_no, F.lit(0)) == i).write.parquet(f"{root}/source/slice-{i}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/source/slice-*")
        run_available(start(ads.parse_ads_log(fx.ads_lines(spark, base, events_df=stream))))
