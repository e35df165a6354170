"""Sharding by minimax contiguous partition (DataFrame functions only), law ``bytes``.

Documents with equal texts form an atomic group; groups are ordered by a 60-bit hash of the text. The
smallest capacity for which a greedy fill needs no more than the given shards is found by binary
search, and the order is cut there. The driver holds a histogram only: bytes per hash prefix, 1024
cells at first. A cell that stops a greedy fill, at the found capacity or at the one below, is split
by its next 10 bits until it is one group, so the cuts are those of the exact search over all
groups while the driver sees a bounded number of cells. Groups larger than an equal share stand
first in the order, each alone in a shard; the rest share the other shards.

Slots count from 0 without gaps within a shard: rows per (shard, small hash cell) give each cell an
offset, rows are numbered within their cell.

Defined cases: a null text has no bytes (size 1) and goes with the empty texts (crc32 0). Null or
repeated doc_ids are rows like others. Shards may be empty when groups are fewer. An empty table
gives an empty result. Extra columns stay in :func:`sharded`; the added ones replace their namesakes.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.store import written

SHARDS = 16
CELL_BITS = 10
HASH_BITS = 60
SLOT_CELLS = 1024


@dataclass(frozen=True)
class Cell:
    start: int      # first hash of the cell
    bits: int       # hash bits below the cell's prefix
    bytes: int
    single: bool    # one group only


@dataclass(frozen=True)
class Plan:
    giants: tuple[int, ...]     # hashes of groups alone in shards 0, 1, ...
    cuts: tuple[int, ...]       # first hashes of the shards after the first of the rest
    capacity: int


def text_hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - HASH_BITS)


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _cells(base: DataFrame, parents: list[Cell]) -> list[Cell]:
    """The next CELL_BITS of the given cells (none: of all hashes). At most 1024 rows per parent."""
    bits = (parents[0].bits if parents else HASH_BITS) - CELL_BITS
    if parents:
        base = base.where(F.shiftrightunsigned("g", bits + CELL_BITS).isin([c.start >> c.bits for c in parents]))
    rows = base.groupBy(F.shiftrightunsigned("g", bits).alias("p")).agg(
        F.sum("size").alias("bytes"), (F.min("g") == F.max("g")).alias("single"), F.min("g").alias("g")).collect()
    return [Cell(r["p"] << bits, bits, r["bytes"], r["single"]) for r in rows]


def _fill(cells: list[Cell], sums: list[int], capacity: int, shards: int) -> tuple[list[int], list[Cell]]:
    """Greedy fill: index of the first cell of every shard after the first (as long as shards last), and
    the cells that stopped a shard."""
    cuts: list[int] = []
    stops: list[Cell] = []
    at, n = 0, len(cells)
    while at < n and len(cuts) < shards:
        to = bisect_right(sums, (sums[at - 1] if at else 0) + capacity)
        if to < n:
            stops.append(cells[to])
        if to == at:
            return [*cuts, *[at] * (shards - len(cuts))], stops
        at = to
        cuts.append(at)
    return cuts, stops


def _smallest(cells: list[Cell], shards: int) -> tuple[int, list[int], list[Cell]]:
    """The smallest capacity, its cuts, and the cells that stop fills at it or at the one below."""
    sums = list(accumulate(c.bytes for c in cells))
    fits = lambda c: (_fill(cells, sums, c, shards)[0] or [0])[-1] == len(cells)
    low, high = -(-sums[-1] // shards), sums[-1]
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    cuts, stops = _fill(cells, sums, low, shards)
    return low, [c for c in cuts if c < len(cells)], stops + _fill(cells, sums, low - 1, shards)[1]


def plan(base: DataFrame, shards: int = SHARDS) -> Plan:
    """Cuts for rows (g, size). Every round splits the few cells that matter, in one job per depth."""
    cells = sorted(_cells(base, []), key=lambda c: c.start)
    if not cells:
        return Plan((), (), 0)
    while True:
        giants, rest, split = [], cells, []
        while True:
            left = shards - len(giants)
            share = sum(c.bytes for c in rest) / max(1, left)
            big = [c for c in rest if c.bytes > share]
            split = [c for c in big if not c.single]
            top = max((c for c in big if c.single), key=lambda c: (c.bytes, -c.start), default=None)
            if split or top is None or left <= 1:
                break
            giants.append(top)
            rest = [c for c in rest if c != top]
        capacity, cuts = 0, []
        if not split and rest:
            capacity, cuts, stops = _smallest(rest, shards - len(giants))
            split = [c for c in dict.fromkeys(stops) if not c.single]
        split = [c for c in split if c.bits > 0]
        if not split:
            return Plan(tuple(c.start if c.single and c.bits == 0 else _group(base, c) for c in giants),
                        tuple(rest[i].start for i in cuts), capacity)
        fresh: list[Cell] = []
        for bits in sorted({c.bits for c in split}):
            fresh += _cells(base, [c for c in split if c.bits == bits])
        gone = set(split)
        cells = sorted([c for c in cells if c not in gone] + fresh, key=lambda c: c.start)


def _group(base: DataFrame, cell: Cell) -> int:
    return base.where(F.shiftrightunsigned("g", cell.bits) == cell.start >> cell.bits).agg(F.min("g")).first()[0]


def shard_of(g: Column, p: Plan) -> Column:
    out = F.lit(len(p.giants))
    for cut in p.cuts:
        out = out + (g >= cut).cast("int")
    for k, giant in enumerate(p.giants):
        out = F.when(g == giant, F.lit(k)).otherwise(out)
    return out


def _base(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_bytes(F.col("text")).alias("size"), text_hash(F.col("text")).alias("g"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs`` (doc_id, text)."""
    base = written(_base(docs), "sizes")
    p = plan(base, shards)
    rows = base.withColumn("shard", shard_of(F.col("g"), p)) \
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "g", "size"), F.lit(SLOT_CELLS)))
    # At most shards * SLOT_CELLS rows.
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    numbered = rows.withColumn("k", F.row_number().over(
        Window.partitionBy("shard", "cell").orderBy("doc_id", "g", "size")) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "cell"]).select(
        "doc_id", "size", F.col("text_crc32").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with its shard: all columns, and ``size``, ``text_crc32``, ``law``, ``shard``."""
    p = plan(written(_base(docs).select("g", "size"), "sizes"), shards)
    text = F.col("text")
    added = {"size": text_bytes(text), "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
             "law": F.lit("bytes"), "shard": shard_of(text_hash(text), p)}
    keep = [c for c in docs.columns if c.lower() not in added]
    return docs.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(k) for k, v in added.items()])
