"""Prefix trie of conversations: every distinct sequence of first turns is a node.

A turn is known by two 64-bit hashes of (role, text). Conversations are cut into segments of ``WIDTH``
turns, each with a key of all turns before it, so a conversation of any length is rows of bounded size.
Segments are range-partitioned by (segment number, key, turns, id): a shard holds neighbours of the sorted
order, and a node is a run of rows in it. A shard numbers its distinct turns, writes them into a padded
matrix (a row per segment, a column per depth, 0 where a conversation has ended), sorts it with ``lexsort``
and ORs the changes between neighbouring rows column by column: the mask of a column marks where its nodes
start, and sums between marks give every node's members, children, leaves and savings.

Only runs that touch a shard's first or last row can go on in another shard. These few nodes (at most two
for each column and shard, and the root) are emitted as parts and added up by key in Spark. What lies in
later segments reaches the nodes above through the rows: a node's savings and a leaf's mark are credited
to its smallest member, and a running sum over that conversation's segments hands them on.

Rules: rows without a conversation id take no part; a null role or text is empty; turns stand in order of
``turn``, null first, and turns with equal numbers by the hashes of role and text; repeated rows are turns
of their own; other columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopflow.llm.store import written

WIDTH = 32              # turns of a segment: columns of a matrix
SHARD_TURNS = 1 << 18   # turns of a shard, about
CHUNK = 1 << 13         # conversation ids of one piece of a list of ends
NODE, PART, TOP, ENDS = range(4)
EMPTY = hashlib.sha256(b"").hexdigest()

OUT = "kind int, key binary, depth long, conv_id long, parent_conv_id long, parent_key binary, n_convs long, " \
      "n_children long, n_leaves long, saved long, own_leaf long, own_saved long, bytes long, down binary, ends string, " \
      "above array<binary>, first long"
_TYPES = [pa.int32(), pa.binary(), *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 7, pa.binary(), pa.string(),
          pa.list_(pa.binary()), pa.int64()]
_NAMES = [c.split()[0] for c in OUT.split(", ")]


def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, bytes): turns numbered from 0 in their conversation. Rows are range-partitioned
    and numbered where they lie, so a conversation that holds a third of them is many tasks; the counts of
    the partitions before then move the numbers up."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    keyed = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"), F.octet_length(text).cast("long").alias("bytes"))
    order = ["conv_id", "turn", "h1", "h2"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            start = np.r_[ids[0] != conv, ids[1:] != ids[:-1]]
            at = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(start, at, 0))
            pos = at - begin + np.where(begin > 0, 0, 0 if start[0] else n)
            conv, n = ids[-1], int(pos[-1]) + 1
            yield pa.record_batch([batch.column("conv_id"), pa.array(pos), batch.column("h1"), batch.column("h2"),
                                   batch.column("bytes"), pa.array(np.full(len(ids), part, np.int32))],
                                  names=["conv_id", "pos", "h1", "h2", "bytes", "part"])

    local = written(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        number, "conv_id long, pos long, h1 long, h2 long, bytes long, part int"), "turns")
    counts = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    moved = counts.withColumn("before", before).where("before is not null").drop("n")
    return local.join(moved, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, total, pos, h1, h2, bytes) of every conversation ``c`` after it took over the first
    ``h = crc32(c) % most`` turns of conversation ``c - c % family`` in place of its own first ``h``; a
    conversation left without turns is one row with a null ``pos``."""
    turn = F.struct("pos", "h1", "h2", "bytes")
    heads = turns.where((F.col("pos") < most - 1) & (F.col("conv_id") % family == 0)).groupBy("conv_id") \
        .agg(F.sort_array(F.collect_list(turn)).alias("head")).withColumnRenamed("conv_id", "base")  # most - 1 turns at most
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")) \
        .withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")) \
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(
        "array<struct<pos:bigint,h1:bigint,h2:bigint,bytes:bigint>>")))
    convs = convs.withColumn("taken", F.size("head")).withColumn(
        "total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    copied = convs.select("conv_id", "total", F.explode_outer("head").alias("t")).select("conv_id", "total", "t.*") \
        .where("pos is not null or total = 0")
    own = turns.join(convs.select("conv_id", "total", "h", "taken"), "conv_id").where("pos >= h") \
        .withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    return copied.unionByName(own.select("conv_id", "total", "pos", "h1", "h2", "bytes"))


def segments(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, seg, p1, p2, h1, h2, bytes, n1, n2, last): lists of ``width`` turns, the key (p1, p2) of all
    turns before them and the key (n1, n2) of those with them."""
    one = turns.groupBy("conv_id", F.coalesce(F.floor(F.col("pos") / width), F.lit(0)).cast("int").alias("seg")) \
        .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct(
            "pos", "h1", "h2", "bytes")))).alias("t"))  # width turns at most
    one = one.select("conv_id", "seg", "total", *[F.col(f"t.{c}").alias(c) for c in ("h1", "h2", "bytes")])
    by = Window.partitionBy("conv_id").orderBy("seg")
    for k in (1, 2):
        own = F.xxhash64(F.lit(k), F.col("seg"), F.col("h1"), F.col("h2"))
        one = one.withColumn(f"o{k}", own).withColumn(
            f"p{k}", F.coalesce(F.bit_xor(f"o{k}").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        one = one.withColumn(f"n{k}", F.col(f"p{k}").bitwiseXOR(F.col(f"o{k}")))
    return one.withColumn("last", (F.col("seg") + 1) * width >= F.col("total")).drop("o1", "o2", "total")


def _top_key(seg: int, p1: int, p2: int) -> bytes:
    return hashlib.blake2b(struct.pack("<bqqq", 1, seg, p1, p2), digest_size=16).digest()


ROOT = _top_key(0, 0, 0)


def _flat(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of a list column."""
    parts = [(np.asarray(c.offsets, dtype=np.int64), np.asarray(c.values)) for c in col.chunks]
    return (np.concatenate([np.diff(o) for o, _ in parts]), np.concatenate([v[o[0]:o[-1]] for o, v in parts]))


def _number(*keys: np.ndarray) -> np.ndarray:
    """Dense numbers from 1 of the distinct tuples of several columns, in their order."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    o = np.lexsort(keys[::-1])
    new = np.zeros(len(o), dtype=bool)
    for k in keys:
        new[1:] |= k[o][1:] != k[o][:-1]
    out = np.empty(len(o), np.int64)
    out[o] = np.cumsum(new) + 1
    return out


class _Shard:
    """The sorted rows of one shard."""

    def __init__(self, t: pa.Table, width: int) -> None:
        seg, p1, p2, conv = (t[c].to_numpy() for c in ("seg", "p1", "p2", "conv_id"))
        size, h1 = _flat(t["h1"])
        h2, byte = _flat(t["h2"])[1], _flat(t["bytes"])[1]
        held = np.arange(width) < size[:, None]
        turn = np.zeros((len(size), width), np.int64)
        turn[held] = _number(h1, h2)
        group = _number(seg, p1, p2)
        goes_on = ~t["last"].to_numpy()
        order = np.lexsort((conv, goes_on, *turn.T[::-1], group))
        self.turn, self.group, self.conv, self.size = turn[order], group[order], conv[order], size[order]
        self.byte = np.zeros_like(turn)
        self.byte[held] = byte
        self.byte = self.byte[order]
        self.seg, self.p1, self.p2 = seg[order], p1[order], p2[order]
        self.n1, self.n2 = t["n1"].to_numpy()[order], t["n2"].to_numpy()[order]
        self.last = ~goes_on[order]
        self.leaf, self.saved = t["deep_leaf"].to_numpy()[order], t["deep_saved"].to_numpy()[order]
        at = np.cumsum(size) - size
        self.hashes = [(h1[at[k]:at[k] + size[k]], h2[at[k]:at[k] + size[k]]) for k in (order[0], order[-1])]
        self.width = width

    def key(self, row: int, depth: int) -> bytes:
        """The key of the node of ``depth`` columns on the path of the shard's first (0) or last row (-1)."""
        if depth == 0:
            return _top_key(int(self.seg[row]), int(self.p1[row]), int(self.p2[row]))
        a, b = self.hashes[row]
        head = struct.pack("<bqqqq", 2, int(self.seg[row]), int(self.p1[row]), int(self.p2[row]), depth)
        return hashlib.blake2b(head + a[:depth].tobytes() + b[:depth].tobytes(), digest_size=16).digest()

    def nodes(self) -> Iterator[list]:
        """Rows of the schema OUT, as columns: whole nodes, parts of nodes that may go on in other shards,
        parts of the nodes above the segments, and pieces of the lists of those parts' ends."""
        m, w = self.turn.shape
        leaf, saved = self.leaf.astype(np.int64), self.saved.astype(np.int64)
        change = np.r_[True, self.group[1:] != self.group[:-1]]
        runs = [np.flatnonzero(change)]
        masks = []
        for j in range(w):  # changes add up from column to column
            change = change | np.r_[True, self.turn[1:, j] != self.turn[:-1, j]]
            masks.append(change)
        texts = np.array([str(c) for c in self.conv.tolist()], dtype=object)
        below = np.zeros(m + 1, np.int64)  # nodes of the next column before each row
        first_key = {d: self.key(0, d) for d in range(int(self.size[0]) + 1)}
        last_key = {d: self.key(-1, d) for d in range(int(self.size[-1]) + 1)}
        for depth in range(w, -1, -1):
            if depth:
                start = np.flatnonzero(masks[depth - 1])
                end = np.r_[start[1:], m]
                real = self.turn[start, depth - 1] != 0
                start, end = start[real], end[real]
            else:
                start, end = runs[0], np.r_[runs[0][1:], m]
            if not len(start):
                continue
            edge = (start == 0) | (end == m) if depth else np.ones(len(start), bool)
            n = end - start
            members = np.minimum.reduceat(np.r_[self.conv, 0], np.c_[start, end].ravel())[::2]
            children = below[end] - below[start]
            going = np.r_[0, np.cumsum(~self.last)] if depth == w else np.zeros(m + 1, np.int64)
            more = going[end] - going[start]
            byte = self.byte[start, depth - 1] if depth else np.zeros(len(start), np.int64)
            own_saved = (n - 1) * byte
            own_leaf = ((children == 0) & (more == 0)).astype(np.int64)
            inner = np.flatnonzero(~edge)
            leaf[start[inner]] += own_leaf[inner]
            saved[start[inner]] += own_saved[inner]
            sums = [np.r_[0, np.cumsum(x)] for x in (leaf, saved)]
            leaves, saving = (s[end] - s[start] for s in sums)
            level = self.seg[start].astype(np.int64) * w + depth
            down = [_top_key(int(self.seg[r]) + 1, int(self.n1[r]), int(self.n2[r])) if c else None
                    for r, c in zip(start, more)] if depth == w else [None] * len(start)
            closing = np.r_[0, np.cumsum((self.size == depth) & self.last)]
            ended = closing[end] - closing[start]  # rows that end here come first in the run
            # The parent's run, and whether it lies inside this shard.
            if len(inner):
                if depth > 1:
                    up = np.flatnonzero(masks[depth - 2])
                else:
                    up = runs[0]
                k = np.searchsorted(up, start[inner], "right") - 1
                a, b = up[k], np.r_[up[1:], m][k]
                low = np.minimum.reduceat(self.conv, up)[k]
                outer = (a == 0) | (b == m) if depth > 1 else np.ones(len(a), bool)
                tops = {r: self.key_of_group(r) for r in np.unique(a)} if depth == 1 else {}
                parent = [None if not o else tops[r] if depth == 1 else first_key[depth - 1] if r == 0 else last_key[depth - 1]
                          for o, r in zip(outer, a)]
                ends = [EMPTY if not e else hashlib.sha256(",".join(texts[s:s + e]).encode()).hexdigest()
                        for s, e in zip(start[inner], ended[inner])]
                z = len(inner)
                yield [[NODE] * z, [None] * z, level[inner], members[inner], [None if o else c for o, c in zip(outer, low.tolist())],
                       parent, n[inner], children[inner], leaves[inner], saving[inner], own_leaf[inner], own_saved[inner],
                       byte[inner], [down[i] for i in inner], ends, [None] * z, [None] * z]
            for i in np.flatnonzero(edge):
                s, e, g = int(start[i]), int(end[i]), int(self.seg[start[i]])
                keys = first_key if s == 0 else last_key
                if depth == 0 and g > 0:  # the node above this segment: only the children seen here
                    yield [[TOP], [self.key_of_group(s)], *[[None]] * 5, [children[i]], *[[None]] * 9]
                    continue
                key = keys[depth] if depth else ROOT
                above = [keys[d] for d in range(0 if g == 0 else 1, depth)]
                yield [[PART], [key], [level[i]], [members[i]], [None], [keys[depth - 1] if depth else None], [n[i]],
                       [children[i]], [leaves[i]], [saving[i]], [None], [None], [byte[i]], [down[i]], [None], [above], [None]]
                for c in range(s, s + int(ended[i]), CHUNK):
                    to = min(c + CHUNK, s + int(ended[i]))
                    yield [[ENDS], [key], *[[None]] * 12, [",".join(texts[c:to])], [None], [int(self.conv[c])]]
            if depth:
                marks = np.zeros(m, np.int64)
                marks[start[inner]] = 1
                below = np.r_[0, np.cumsum(marks)]

    def key_of_group(self, row: int) -> bytes:
        return _top_key(int(self.seg[row]), int(self.p1[row]), int(self.p2[row]))


def _shard(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            for cols in _Shard(pa.Table.from_batches(held), width).nodes():
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, in a stream: no list of ends is ever held whole."""
    key, sha = None, None
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    yield pa.record_batch([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends"])
                key, sha = k, hashlib.sha256(piece.encode())
            else:
                sha.update(b"," + piece.encode())
    if key is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends"])


def _joined(rows: DataFrame, key: str, other: DataFrame) -> DataFrame:
    """A left join in which rows without a key do not travel."""
    with_key = rows.where(F.col(key).isNotNull()).join(other, key, "left")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema if f.name != key]
    return with_key.unionByName(rows.where(F.col(key).isNull()).select("*", *missing))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _shards(segs: DataFrame, width: int, shards: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(whole nodes, nodes added up from parts, children of nodes above segments), from one pass."""
    order = ["seg", "p1", "p2", "h1", "h2", F.desc("last"), "conv_id"]
    found = written(segs.repartitionByRange(shards, *order).mapInArrow(_shard(width), OUT), "nodes")
    whole = found.where(F.col("kind") == NODE)
    # At most two rows for each column and shard, and what they hold of the root.
    parts = found.where(F.col("kind") == PART).groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved").alias("inner_saved"), F.first("bytes").alias("bytes"), F.max("down").alias("down"),
        F.first("above").alias("above"))
    parts = written(parts, "parts")
    kids = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("outer"))
    tops = found.where(F.col("kind") == TOP).groupBy("key").agg(F.sum("n_children").alias("inner"))
    tops = tops.join(kids, "key", "full").select(F.col("key").alias("down"), (_zero("inner") + _zero("outer")).alias("kids"))
    parts = parts.join(kids, "key", "left").withColumn("n_children", F.col("inner") + _zero("outer")) \
        .withColumn("own_leaf", F.when((F.col("n_children") == 0) & F.col("down").isNull(), 1).otherwise(0).cast("long")) \
        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("bytes"))
    sums = parts.select(F.explode(F.array_append("above", F.col("key"))).alias("key"), "own_leaf", "own_saved") \
        .groupBy("key").agg(F.sum("own_leaf").alias("more_leaves"), F.sum("own_saved").alias("more_saved"))
    ends = found.where(F.col("kind") == ENDS).select("key", "first", "ends").repartition("key") \
        .sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends string")
    parts = parts.join(sums, "key", "left").join(ends, "key", "left").select(
        "key", "depth", "conv_id", "parent_key", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("inner_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("inner_saved") + F.col("more_saved")).alias("saved"), "own_leaf", "own_saved", "down",
        F.coalesce("ends", F.lit(EMPTY)).alias("ends"))
    return whole.select(parts.columns), parts, tops


def trie(conversations: DataFrame, width: int = WIDTH, shard_turns: int = SHARD_TURNS, family: int = 5,
         most: int = 9) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row per
    node. ``conv_id`` is the smallest conversation through it, ``saved_tokens`` the bytes of last turns that
    all but one of a node's conversations repeat, summed over the subtree, ``ends_sha256`` the digest of the
    ids that end here, ascending."""
    spark = conversations.sparkSession
    segs = written(segments(rebuilt(ordered(conversations), family, most), width), "segments")
    turns = segs.agg(F.sum(F.size("h1")).alias("n")).first()["n"] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // shard_turns + 1)
    none = [F.lit(0).cast("long").alias(c) for c in ("deep_leaf", "deep_saved")]

    # Later segments first: what their nodes save and which of them are leaves, credited to smallest members.
    whole, parts, _ = _shards(segs.where("seg > 0").select("*", *none), width, shards)
    seg_of = F.floor((F.col("depth") - 1) / width).cast("int").alias("seg")
    credit = whole.select("conv_id", seg_of, "own_leaf", "own_saved").unionByName(
        parts.select("conv_id", seg_of, "own_leaf", "own_saved")).groupBy("conv_id", "seg") \
        .agg(F.sum("own_leaf").alias("own_leaf"), F.sum("own_saved").alias("own_saved"))
    later = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(1, Window.unboundedFollowing)
    deep = segs.where("seg > 0 or not last").select("conv_id", "seg").join(credit, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", F.sum("own_leaf").over(later).alias("deep_leaf"), F.sum("own_saved").over(later).alias("deep_saved"))
    deep = written(deep, "deep")

    ready = segs.join(deep, ["conv_id", "seg"], "left").withColumn("deep_leaf", _zero("deep_leaf")) \
        .withColumn("deep_saved", _zero("deep_saved"))
    whole, parts, tops = _shards(ready, width, shards)
    every = whole.unionByName(parts)
    crossing = every.where("down is not null").select(F.col("down").alias("parent_key"), F.col("conv_id").alias("up"))
    above = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up")).unionByName(crossing)
    every = _joined(_joined(every, "down", tops), "parent_key", above)
    return every.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs",
        F.coalesce("kids", "n_children").alias("n_children"), "n_leaves", F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))
