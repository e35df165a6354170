"""Single-hop page conversion along a target page flow.

rate(a -> b) = round_half_up(hops(a -> b) / visits(a) * 1000) / 10, for consecutive pages a, b of
the flow. A hop is an action followed by the next action of the same session in time order.

Successors are found without a self join and without gathering a session, an hour or a second of one in
one task: actions are range-partitioned by (session, time, tie-break), so a busy session splits anywhere,
and sorted where they lie; a task pairs neighbours as they stream by. The last action of each partition is
then paired with the first of the next one through a window over one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.exprs import parse_action_time, percent
from shopflow.operators.conditions import target_flow
from shopflow.operators.sessions import tiebreak_col

NO_PAGE = -(1 << 63)  # stands for a null page between neighbours; no page has this id


def _flow(flow) -> list[int]:
    pages = target_flow({"targetPageFlow": flow}) if isinstance(flow, str) else [int(p) for p in flow]
    if len(pages) < 2:
        raise ValueError("a page flow needs at least two pages")
    return pages


def flow_hops(flow) -> list[tuple[int, int]]:
    """Consecutive pages of the flow; a hop that the flow repeats is listed once."""
    pages = _flow(flow)
    return list(dict.fromkeys(zip(pages[:-1], pages[1:])))


def flow_jumps(flow) -> list[str]:
    """``a_b`` labels of the flow's hops."""
    return [f"{a}_{b}" for a, b in flow_hops(flow)]


def page_visit_counts(actions: DataFrame, flow) -> DataFrame:
    """Visits per page of the flow except its last page (F3, A7); the list is a parameter."""
    pages = _flow(flow)[:-1]
    return (actions.filter(F.col("page_id").isin(pages))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("n")))


def in_order(actions: DataFrame) -> DataFrame:
    """(session, page_id, timed, session_id) in (session, time, tie-break) order across range partitions. An
    action whose time does not parse is not ``timed`` and follows nothing."""
    a = actions.select("session_id", "page_id", parse_action_time("action_time").alias("action_ts"),
                       tiebreak_col(actions).alias("_tb"))
    order = ["session_id", "action_ts", "_tb"]
    key = F.concat(F.when(F.col("session_id").isNull(), "-").otherwise("+"), F.coalesce(F.col("session_id").cast("string"), F.lit("")))
    return a.repartitionByRange(*order).sortWithinPartitions(*order).select(
        key.alias("session"), F.col("page_id").cast("long").alias("page_id"), F.col("action_ts").isNotNull().alias("timed"),
        "session_id")


def _neighbours(batches: Iterator[pa.RecordBatch]):
    """Per batch of a sorted partition: the batch, the page before each action, its page, and whether the two
    follow each other in a session."""
    last = (None, NO_PAGE, False)
    for b in batches:
        if not b.num_rows:
            continue
        s, p = b.column("session"), b.column("page_id").fill_null(NO_PAGE).to_numpy()
        t = b.column("timed").to_numpy(zero_copy_only=False)
        same = np.r_[last[0] == s[0].as_py(), pc.equal(s[1:], s[:-1]).to_numpy(zero_copy_only=False)].astype(bool)
        yield b, np.r_[last[1], p[:-1]], p, same & t & np.r_[last[2], t[:-1]]
        last = (s[-1].as_py(), p[-1], bool(t[-1]))


_BORDER = "part int, s0 string, p0 long, t0 boolean, s1 string, p1 long, t1 boolean"
_NAMES = [c.split()[0] for c in _BORDER.split(", ")]
_TYPES = [pa.int32(), *[pa.string(), pa.int64(), pa.bool_()] * 2]


class _Border:
    """First and last action of a partition."""

    def __init__(self) -> None:
        self.first = self.last = None

    def see(self, b: pa.RecordBatch, p: np.ndarray) -> None:
        end = lambda i: (b.column("session")[i].as_py(), int(p[i]), b.column("timed")[i].as_py())
        self.first = self.first or end(0)
        self.last = end(-1)

    def columns(self) -> list[pa.Array]:
        values = (TaskContext.get().partitionId(), *self.first, *self.last)
        return [pa.array([x], t) for x, t in zip(values, _TYPES)]


def _over_borders() -> tuple[Column, Column]:
    """(page before, page) of the last action of a partition and the first of the next one that has rows, null
    where they do not follow each other. One row per partition is ordered."""
    w = Window.orderBy("part")
    meets = (F.lead("s0").over(w) == F.col("s1")) & F.col("t1") & F.lead("t0").over(w)
    return F.when(meets, F.col("p1")), F.when(meets, F.lead("p0").over(w))


def page_hops(actions: DataFrame) -> DataFrame:
    """Every (session_id, from_page, to_page) of consecutive actions in a session."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border, names = _Border(), ["session", "from_page", "to_page", *_NAMES]
        none = lambda n: [pa.nulls(n, t) for t in _TYPES]
        for b, before, page, follows in _neighbours(batches):
            border.see(b, page)
            at = np.flatnonzero(follows & (page != NO_PAGE))
            yield pa.record_batch([b.column("session").take(pa.array(at)), pa.array(before[at]), pa.array(page[at]),
                                   *none(len(at))], names=names)
        if border.first:
            yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                                   *border.columns()], names=names)

    found = in_order(actions).mapInArrow(run, f"session string, from_page long, to_page long, {_BORDER}")
    before, page = _over_borders()
    across = found.where("part is not null").select(F.col("s1").alias("session"), before.alias("from_page"), page.alias("to_page")) \
        .where(F.col("to_page").isNotNull() & (F.col("to_page") != NO_PAGE))
    return found.where("part is null").select("session", "from_page", "to_page").unionByName(across).select(
        F.when(F.col("session").startswith("+"), F.substr("session", F.lit(2))).alias("session_id"),
        F.nullif("from_page", F.lit(NO_PAGE)).alias("from_page"), "to_page")


def flow_counts(actions: DataFrame, flow) -> DataFrame:
    """Per target hop: ``page_jump``, ``from_page``, ``n`` (times it happened, 0 included) and ``visits``
    of its first page (L5, F3, F5, A7, A8). One pass: actions are ordered once across range partitions and
    each partition becomes one row with its hop and visit counters and its border actions; only those rows
    meet, to count the hops across partitions.
    Actions whose time does not parse count as visits and make no hop."""
    hops = flow_hops(flow)
    starts = list(dict.fromkeys(x for x, _ in hops))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border, h, v = _Border(), [0] * len(hops), [0] * len(starts)
        for b, before, page, follows in _neighbours(batches):
            border.see(b, page)
            for i, (x, y) in enumerate(hops):
                h[i] += int(np.count_nonzero(follows & (before == x) & (page == y)))
            for i, x in enumerate(starts):
                v[i] += int(np.count_nonzero(page == x))
        if border.first:
            yield pa.record_batch([*border.columns(), pa.array([h], pa.list_(pa.int64())),
                                   pa.array([v], pa.list_(pa.int64()))], names=[*_NAMES, "h", "v"])

    parts = in_order(actions).drop("session_id").mapInArrow(run, f"{_BORDER}, h array<long>, v array<long>")
    before, page = _over_borders()
    total = parts.select("h", "v", before.alias("_before"), page.alias("_page")).agg(
        *[F.sum(F.col("h")[i] + F.when((F.col("_before") == x) & (F.col("_page") == y), 1).otherwise(0)).alias(f"h{i}")
          for i, (x, y) in enumerate(hops)],
        *[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(len(starts))])
    zero = F.lit(0).cast("long")
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(f"{x}_{y}").alias("page_jump"), F.lit(x).cast("long").alias("from_page"),
                 F.coalesce(f"h{i}", zero).alias("n"), F.coalesce(f"v{starts.index(x)}", zero).alias("visits"))
        for i, (x, y) in enumerate(hops)])))


def page_jump_counts(actions: DataFrame, flow, chunk_seconds: int | None = None) -> DataFrame:
    """Count of each target hop ``a_b`` (F5, A8). Hops that never happen are absent. ``chunk_seconds`` is for
    callers of the form that cut sessions into time chunks; ranges of rows need none, so it changes nothing."""
    return flow_counts(actions, flow).filter(F.col("n") > 0).select("page_jump", "from_page", "n")


def page_convert_rate(actions: DataFrame, flow, include_zero: bool = False) -> DataFrame:
    """Conversion rate per target hop (J6, C10), from one pass over the actions.

    ``include_zero=True`` adds hops that never happen with rate 0.0 (D12).
    """
    counts = flow_counts(actions, flow)
    counts = counts if include_zero else counts.filter(F.col("n") > 0)
    return counts.select("page_jump", percent("n", "visits", 1).alias("rate"))
