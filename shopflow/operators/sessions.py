"""Session rollups, duration / step shares and the hourly proportional sample.

Partitioning: everything groups by ``session_id``. The list columns of ``session_info`` are
built in two levels - first per (session, time chunk), then per session from one short string
per chunk - so a very long session (a bot holding a large share of all rows) is sorted and
concatenated by many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.exprs import parse_action_time, percent, sorted_join, time_chunk

DEFAULT_CHUNK_SECONDS = 3600
ITEM_CHUNK_SECONDS = 60
SAMPLE_SIZE = 1000


def tiebreak_col(df: DataFrame, tiebreak: str | None = None) -> Column:
    """Order of actions within the same second: the given column, ``event_id`` when present,
    else a hash of the whole row (deterministic, so recomputed tasks give the same order)."""
    if tiebreak:
        return F.col(tiebreak)
    if "event_id" in df.columns:
        return F.col("event_id")
    return F.xxhash64(*[F.col(c) for c in df.columns])


def with_action_ts(actions: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Parsed ``action_ts`` and tie-break ``_tb``; rows whose time does not parse are left out
    here and reported by :func:`rejected_actions`."""
    return (actions.withColumn("action_ts", parse_action_time("action_time"))
            .withColumn("_tb", tiebreak_col(actions, tiebreak))
            .filter(F.col("action_ts").isNotNull()))


def rejected_actions(actions: DataFrame) -> DataFrame:
    """Actions with an unparsable ``action_time``, with the reason."""
    return (actions.filter(parse_action_time("action_time").isNull())
            .withColumn("reason", F.lit("unparsable action_time")))


def session_stats(actions: DataFrame) -> DataFrame:
    """Scalar session facts: visit_length (s), step_length, start_time (partial + final agg)."""
    a = with_action_ts(actions)
    g = a.groupBy("session_id").agg(F.min("action_ts").alias("start_ts"),
                                    F.max("action_ts").alias("end_ts"),
                                    F.count(F.lit(1)).alias("step_length"))
    return g.select(
        "session_id",
        (F.unix_seconds("end_ts") - F.unix_seconds("start_ts")).alias("visit_length"),
        "step_length",
        F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        "start_ts",
    )


def _item(cond: Column, value: Column) -> Column:
    return F.when(cond, F.struct(F.col("action_ts").alias("t"), F.col("_tb").alias("b"),
                                 value.cast("string").alias("v")))


_LISTS = {
    "search_keywords": lambda: _item(F.col("search_keyword").isNotNull(), F.col("search_keyword")),
    "click_product_ids": lambda: _item(F.col("click_product_id") > 0, F.col("click_product_id")),
    "order_product_ids": lambda: _item(F.col("order_product_ids").isNotNull(), F.col("order_product_ids")),
    "pay_product_ids": lambda: _item(F.col("pay_product_ids").isNotNull(), F.col("pay_product_ids")),
}


def session_info(actions: DataFrame, chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """One row per session (A1): visit_length, step_length, start_time and four lists
    (search words, clicked products, ordered and paid id lists) in action-time order,
    duplicates kept, empty list -> ``""``.

    Level 1 groups by (session, chunk) and sorts only that chunk's items; level 2 joins the
    chunk strings in chunk order. Chunks are time ranges, so the order is the same as one
    global sort by (action time, tie-break). ``chunk_seconds`` does not change the result.
    """
    a = with_action_ts(actions).withColumn("chunk", time_chunk("action_ts", chunk_seconds))
    lvl1 = a.groupBy("session_id", "chunk").agg(
        F.min("action_ts").alias("t0"), F.max("action_ts").alias("t1"),
        F.count(F.lit(1)).alias("n"),
        *[F.when(F.count(mk()) > 0, sorted_join(F.collect_list(mk()))).alias(name) for name, mk in _LISTS.items()])

    def chunks_joined(name: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(F.col("chunk"), F.col(name).alias("v"))))
        return F.array_join(F.transform(parts, lambda x: x["v"]), ",")  # chunks without items are null: skipped

    lvl2 = lvl1.groupBy("session_id").agg(
        F.min("t0").alias("start_ts"), F.max("t1").alias("end_ts"),
        F.sum("n").alias("step_length"),
        *[chunks_joined(name).alias(name) for name in _LISTS])
    return lvl2.select(
        "session_id",
        (F.unix_seconds("end_ts") - F.unix_seconds("start_ts")).alias("visit_length"),
        F.col("step_length").cast("long").alias("step_length"),
        F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        *_LISTS.keys())


def session_items(actions: DataFrame, chunk_seconds: int = ITEM_CHUNK_SECONDS) -> DataFrame:
    """The lists of :func:`session_info` as rows (A1): (session_id, list, position, value), positions from 1
    in order of (action time, tie-break, value).

    Nothing gathers a session. Items are counted per (session, list, time chunk), partially before the
    shuffle; running sums over those counts tell how many items earlier chunks hold, and an item's
    position is that number plus its place in its own chunk. One task orders the items of one list in
    one chunk at most; ``chunk_seconds`` does not change the result. Sessions without items of a list
    have no rows for it; items of actions without a session id are one session, as in ``session_info``.
    """
    a = with_action_ts(actions).withColumn("chunk", time_chunk("action_ts", chunk_seconds))
    found = F.explode(F.array(*[F.struct(F.lit(name).alias("list"), mk().alias("item")) for name, mk in _LISTS.items()]))
    items = (a.select("session_id", "chunk", found.alias("f")).filter(F.col("f.item").isNotNull())
             .select("session_id", "f.list", "chunk", "f.item"))
    earlier = Window.partitionBy("session_id", "list").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (items.groupBy("session_id", "list", "chunk").agg(F.count(F.lit(1)).alias("n"))
              .select("session_id", "list", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    i, c = items.alias("i"), starts.alias("c")
    place = F.row_number().over(Window.partitionBy("i.session_id", "i.list", "i.chunk").orderBy("i.item"))
    return i.join(c, F.expr("i.session_id <=> c.session_id and i.list = c.list and i.chunk = c.chunk")).select(
        "i.session_id", "i.list", (F.col("c.before") + place).cast("long").alias("position"), F.col("i.item.v").alias("value"))


def session_counts(sessions: DataFrame, max_seconds: int = 10, max_steps: int = 5) -> DataFrame:
    """Five counters over all sessions (A2): one global aggregate, partial per task."""
    v, s = F.col("visit_length"), F.col("step_length")
    return sessions.agg(
        F.count_if(v <= max_seconds).alias(f"visit_length_le_{max_seconds}s"),
        F.count_if(v > max_seconds).alias(f"visit_length_gt_{max_seconds}s"),
        F.count_if(s <= max_steps).alias(f"step_length_le_{max_steps}"),
        F.count_if(s > max_steps).alias(f"step_length_gt_{max_steps}"),
        F.count(F.lit(1)).alias("session_count"))


def session_ratio_stats(sessions: DataFrame, task_id: str, conditions: str = "{}",
                        max_seconds: int = 10, max_steps: int = 5) -> DataFrame:
    """Shares in percent, 2 decimals, half up (A3, F9). No sessions -> all ratios 0.0.
    The step ratios are the true ones (the reference always stored 0.0 for them, D3)."""
    c = session_counts(sessions, max_seconds, max_steps)
    names = [f"visit_length_le_{max_seconds}s", f"visit_length_gt_{max_seconds}s",
             f"step_length_le_{max_steps}", f"step_length_gt_{max_steps}"]
    return c.select(F.lit(task_id).alias("task_id"), F.lit(conditions).alias("conditions"),
                    "session_count",
                    *[percent(n, "session_count", 2).alias(f"{n}_ratio") for n in names])


def _day_hour(sessions: DataFrame) -> Column:
    """Start hour label, from ``start_ts`` or else the ``start_time`` text."""
    start = F.col("start_ts") if "start_ts" in sessions.columns else parse_action_time("start_time")
    return F.date_format(start, "yyyy-MM-dd HH")


def session_hour_quota(sessions: DataFrame, k: int = SAMPLE_SIZE) -> DataFrame:
    """Sessions per start hour and the hour's share of a ``k`` sample.

    quota = floor(n_hour / n_all * k), capped at n_hour (D4: no repeats). The total is a
    scalar subquery over the (small) hour table - no global window, no cross join.
    """
    return _quota(sessions.groupBy(_day_hour(sessions).alias("day_hour")).agg(F.count(F.lit(1)).alias("n_sessions")), k)


def _quota(hours: DataFrame, k: int) -> DataFrame:
    total = hours.select(F.sum("n_sessions")).scalar()
    quota = F.floor(F.col("n_sessions").cast("double") / total.cast("double") * F.lit(float(k)))
    return hours.select("day_hour", "n_sessions",
                        F.least(quota.cast("long"), F.col("n_sessions")).alias("quota"))


def sample_sessions(sessions: DataFrame, k: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """Seeded sample without replacement, proportional to sessions per start hour.

    Inside an hour, sessions are ordered by md5(session_id || seed) and the first ``quota``
    kept. The order is cut by the hash's first three digits: sessions are counted per (hour, prefix),
    running sums over those counts name the prefixes the quota reaches into, and only their sessions
    are joined and ordered, each prefix on its own. No task holds a crowded hour, whatever ``k``.
    """
    named = (sessions.withColumn("day_hour", _day_hour(sessions))
             .withColumn("_h", F.md5(F.concat(F.col("session_id"), F.lit(str(seed)))))
             .withColumn("_cell", F.substring("_h", 1, 3)))
    cells = named.groupBy("day_hour", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    quota = _quota(cells.groupBy("day_hour").agg(F.sum("_n").alias("n_sessions")), k).select("day_hour", "quota")
    w = Window.partitionBy("day_hour").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (cells.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).join(quota, "day_hour")
               .withColumn("_left", F.col("quota") - F.col("_before")).filter(F.col("_left") > 0)
               .select("day_hour", "_cell", "_left"))
    wc = Window.partitionBy("day_hour", "_cell").orderBy("_h", "session_id")
    return (named.join(reached, ["day_hour", "_cell"]).withColumn("_rn", F.row_number().over(wc))
            .filter(F.col("_rn") <= F.col("_left")).drop("_h", "_cell", "_rn", "_left"))
