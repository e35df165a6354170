"""Ad-click log: parsing and the frame-in / frame-out logic of the realtime questions.

The same functions run on a static DataFrame (batch, tests, oracle) and inside streaming
micro-batches (``streaming/ads_stream.py``), so stream results can be checked against batch.

Record: ``ts`` (timestamp), ``area``, ``city``, ``user_id``, ``ads_id`` (text) and ``seq`` (the
source's row id, used only to order events of the same millisecond).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.exprs import json_pairs, time_chunk

BLACKLIST_THRESHOLD = 10000
TOP_ADS = 3


# ---------------------------------------------------------------- S4: text line -> record
def _fields(value: Column) -> Column:
    # Trailing blanks carry no fields (as with Java's split), inner empty fields are kept.
    return F.split(F.rtrim(value), " ")


def parse_ads_log(lines: DataFrame, value: str = "value", seq: str | None = "seq") -> DataFrame:
    """Good records of ``epoch_ms area city user_id ads_id`` lines; extra fields are ignored."""
    return parse_ads_log_with_rejects(lines, value, seq)[0]


def parse_ads_log_with_rejects(lines: DataFrame, value: str = "value",
                               seq: str | None = "seq") -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a short line or a non-numeric time goes to ``rejected`` with a reason
    instead of failing the batch (D22)."""
    parts = _fields(F.col(value))
    millis = F.get(parts, 0).try_cast("long")
    seq_col = F.col(seq).cast("long") if seq and seq in lines.columns else F.lit(None).cast("long")
    staged = lines.select(F.col(value).alias("_line"), parts.alias("_p"), millis.alias("_ms"),
                          seq_col.alias("seq"))
    reason = (F.when(F.size("_p") < 5, F.lit("fewer than 5 fields"))
              .when(F.col("_ms").isNull(), F.lit("time is not a number")))
    staged = staged.withColumn("_reason", reason)
    good = staged.filter(F.col("_reason").isNull()).select(
        F.timestamp_millis("_ms").alias("ts"),
        *[F.get("_p", i).alias(n) for i, n in enumerate(("area", "city", "user_id", "ads_id"), 1)],
        "seq")
    rejected = staged.filter(F.col("_reason").isNotNull()).select(
        F.col("_line").alias("value"), F.col("_reason").alias("reason"), "seq")
    return good, rejected


def with_day(log: DataFrame) -> DataFrame:
    return log.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


# ---------------------------------------------------------------- R8: running daily totals
def area_city_daily(log: DataFrame) -> DataFrame:
    """Clicks per (day, area, city, ad) (T3): partial + final count."""
    return (with_day(log).groupBy("day", "area", "city", "ads_id")
            .agg(F.count(F.lit(1)).alias("n")))


def area_daily(totals: DataFrame) -> DataFrame:
    """Roll the city away: (day, area, city, ad) -> (day, area, ad)."""
    return totals.groupBy("day", "area", "ads_id").agg(F.sum("n").cast("long").alias("n"))


# ---------------------------------------------------------------- R9: top ads per day and area
def area_top_ads(totals: DataFrame, n: int = TOP_ADS, rolled: bool = False) -> DataFrame:
    """Top ``n`` ads per (day, area) by clicks, ties to the smaller ad id.

    ``totals`` is per (day, area, city, ad) unless ``rolled``. The literal limit lets Spark
    keep n rows per (day, area) and task before the shuffle.
    """
    daily = totals if rolled else area_daily(totals)
    w = Window.partitionBy("day", "area").orderBy(F.col("n").desc(), F.col("ads_id").asc())
    return (daily.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
            .withColumn("rn", F.col("rn").cast("long")))


def area_top_ads_json(top: DataFrame) -> DataFrame:
    """Per (day, area) the top list as compact JSON ``[{"ad":n},...]`` in rank order (A15, C14);
    ``date_key`` is the store key ``area_top3_ads:<day>``. One row per (day, area): the map
    of areas per day is these rows (``map_from_entries`` on request, see ``area_top_ads_map``)."""
    g = top.groupBy("day", "area").agg(
        F.array_sort(F.collect_list(F.struct("rn", "ads_id", "n"))).alias("items"))
    return g.select(F.concat(F.lit("area_top3_ads:"), F.col("day")).alias("date_key"), "area",
                    json_pairs("items", "ads_id", "n").alias("top3_json"))


def area_top_ads_map(top_json: DataFrame) -> DataFrame:
    """``date_key -> map(area -> json)``: the key-value form the reference stored per day.
    One map per day, bounded by the number of areas."""
    return top_json.groupBy("date_key").agg(
        F.map_from_entries(F.collect_list(F.struct("area", "top3_json"))).alias("areas"))


# ---------------------------------------------------------------- R7: per-user daily counts, blacklist
def user_daily(log: DataFrame) -> DataFrame:
    """Clicks per (day, user, ad) (T5)."""
    return with_day(log).groupBy("day", "user_id", "ads_id").agg(F.count(F.lit(1)).alias("n"))


def offending_groups(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """(day, user, ad) groups whose click count reaches ``threshold``: a partial + final count,
    so no event row crosses the network."""
    return user_daily(log).filter(F.col("n") >= threshold).select("day", "user_id", "ads_id")


GROUP = ["day", "user_id", "ads_id"]
CHUNK_SECONDS = 60


def threshold_events(events: DataFrame, threshold: int, prior: DataFrame | None = None,
                     chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Per (day, user, ad) the event that brings its count to ``threshold`` (``ts``, ``seq``), counting on
    from ``prev`` of ``prior``. Clicks are counted per (group, time chunk), partially before the
    shuffle; running sums over those counts (at most a day's chunks a group) name the chunk that holds
    the event, and only that chunk's events are ordered, so no task sorts a whole busy group."""
    keyed = events.select(*GROUP, "ts", "seq", time_chunk("ts", chunk_seconds).alias("_chunk"))
    chunks = keyed.groupBy(*GROUP, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*GROUP).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = chunks.withColumn("_total", F.sum("_n").over(w))
    if prior is not None:
        chunks = (chunks.join(prior, GROUP, "left")
                  .withColumn("_total", F.col("_total") + F.coalesce("prev", F.lit(0))).drop("prev"))
    before = F.col("_total") - F.col("_n")
    crossing = (chunks.filter((before < threshold) & (F.col("_total") >= threshold))
                .select(*GROUP, "_chunk", (F.lit(threshold) - before).alias("_k")))
    wn = Window.partitionBy(*GROUP, "_chunk").orderBy("ts", "seq")
    return (keyed.join(crossing, [*GROUP, "_chunk"]).withColumn("_rn", F.row_number().over(wn))
            .filter(F.col("_rn") == F.col("_k")).select(*GROUP, "ts", "seq"))


def blacklist_cutoffs(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                      chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Per listed user, the event that listed it: the earliest event (by ts, seq) that is the
    ``threshold``-th click of some (day, user, ad) (T6, per-event rule)."""
    nth = threshold_events(with_day(log), threshold, chunk_seconds=chunk_seconds)
    return nth.groupBy("user_id").agg(F.min(F.struct("ts", "seq")).alias("cut"))


def blacklist(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users listed for good once one of their (day, ad) counts reaches ``threshold``.
    Under the per-event rule every event before the listing one passes, so a user is listed
    exactly when some group's full count reaches the threshold: counts alone decide it."""
    return offending_groups(log, threshold).select("user_id").distinct()


def kept_events(log: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Events that pass the blacklist filter, event by event (F6, J5): all events of users
    never listed, and a listed user's events up to and including the one that listed it.

    The cut-off table has one row per listed user; Spark broadcasts it when small, else both
    sides shuffle on user_id (AQE splits a skewed user's partition on the log side).
    """
    cut = blacklist_cutoffs(log, threshold)
    j = log.join(cut, "user_id", "left")
    keep = F.col("cut").isNull() | (F.struct("ts", "seq") <= F.col("cut"))
    return j.filter(keep).select(*log.columns)


# ---------------------------------------------------------------- R10: clicks per ad and minute
def minute_counts(log: DataFrame) -> DataFrame:
    """Clicks per (ad, minute) (T7 pre-aggregation: one row per ad and minute, not per event)."""
    return (log.groupBy("ads_id", F.date_trunc("minute", "ts").alias("minute_ts"))
            .agg(F.count(F.lit(1)).alias("n")))


def last_hour(log: DataFrame, as_of=None, minutes: int = 60) -> DataFrame:
    """Clicks per (ad, minute) over the ``minutes`` whole minutes ending at ``as_of``'s minute
    (D16, D17). ``as_of`` defaults to the newest event time.

    With ``as_of`` the log is cut to the window before it is counted. Without, one pass counts every
    (ad, minute), and the newest minute of those counts (a scalar subquery) bounds the result.
    """
    if as_of is not None:
        end = F.lit(as_of).cast("timestamp")
        start = F.timestamp_add("MINUTE", F.lit(-(minutes - 1)), F.date_trunc("minute", end))
        return last_hour_from_minutes(minute_counts(log.filter((F.col("ts") >= start) & (F.col("ts") <= end))))
    counts = minute_counts(log)
    return last_hour_from_minutes(last_minutes(counts, counts.select(F.max("minute_ts")).scalar(), minutes))


def last_minutes(counts: DataFrame, newest: Column, minutes: int = 60) -> DataFrame:
    """Minute counts of the ``minutes`` minutes that end with ``newest``'s."""
    end = F.date_trunc("minute", newest)
    start = F.timestamp_add("MINUTE", F.lit(-(minutes - 1)), end)
    return counts.filter((F.col("minute_ts") >= start) & (F.col("minute_ts") <= end))


def last_hour_from_minutes(counts: DataFrame) -> DataFrame:
    return counts.select("ads_id", F.date_format("minute_ts", "yyyy-MM-dd HH:mm").alias("minute"),
                         F.date_format("minute_ts", "HH:mm").alias("hh_mm"), "n")


def last_hour_json(counts: DataFrame) -> DataFrame:
    """Per ad, ``[{"HH:mm":n},...]`` sorted by full minute (T9); at most 60 entries per ad."""
    g = counts.groupBy("ads_id").agg(
        F.array_sort(F.collect_list(F.struct("minute", "hh_mm", "n"))).alias("items"))
    return g.select("ads_id", json_pairs("items", "hh_mm", "n").alias("series_json"))


# ---------------------------------------------------------------- T8: sliding event-time counts
def _seconds(spec: str) -> int:
    num, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(num) * mult


def sliding_counts(log: DataFrame, size: str = "60 minutes", slide: str = "10 minutes",
                   key: str = "ads_id") -> DataFrame:
    """Clicks per (sliding window, key): windows of ``size`` every ``slide``, aligned to the epoch
    (same windows as ``F.window(ts, size, slide)``).

    When ``slide`` divides ``size``, events are first counted per slide-long pane and each pane
    count is then added to its size/slide windows, instead of copying every event into each
    window it belongs to. On a stream (its ``ts`` watermarked) these are two event-time
    aggregations, the second over the panes that the watermark has closed.
    """
    size_s, slide_s = _seconds(size), _seconds(slide)
    if size_s % slide_s != 0:
        g = log.groupBy(F.window("ts", size, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
        return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")
    if log.isStreaming:
        panes = log.groupBy(F.window("ts", slide).alias("pane"), key).agg(F.count(F.lit(1)).alias("c"))
        g = panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("w"), key).agg(F.sum("c").alias("n"))
        return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")
    step_ms = slide_s * 1000
    pane = F.floor(F.unix_millis("ts") / F.lit(step_ms)) * F.lit(step_ms)
    return windows_of_panes(log.groupBy(pane.alias("pane_ms"), key).agg(F.count(F.lit(1)).alias("c")), size, slide, key)


def windows_of_panes(panes: DataFrame, size: str, slide: str, key: str = "ads_id") -> DataFrame:
    """Sums per (window, key) of pane counts (pane_ms, key, c): each pane goes to its size/slide windows."""
    size_ms, step_ms = _seconds(size) * 1000, _seconds(slide) * 1000
    spread = panes.select(F.explode(F.sequence(F.lit(0), F.lit(size_ms // step_ms - 1))).alias("j"), "pane_ms", key, "c")
    start_ms = F.col("pane_ms") - F.col("j") * F.lit(step_ms)
    g = spread.groupBy(start_ms.alias("start_ms"), key).agg(F.sum("c").cast("long").alias("n"))
    return g.select(F.timestamp_millis("start_ms").alias("window_start"),
                    F.timestamp_millis(F.col("start_ms") + F.lit(size_ms)).alias("window_end"),
                    key, "n")
