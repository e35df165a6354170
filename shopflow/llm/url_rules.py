"""URL rules by a sort-merge range join.

A host is keyed by its labels in reverse, each followed by a mark that no (escaped) label holds, so a
rule's host and all its subdomains are the keys with one prefix: one interval; intervals nest or are
disjoint. Pages are range-partitioned and sorted by key; every partition gets the rules whose
intervals meet it, in the same order, and one sweep keeps the stack of rules around the current key.
A page takes, of the hosts on the stack, the longest rule whose path its own path starts with.

The partition bounds are quantiles of a bounded hash sample of page keys; the key ends with the page's
path and id, so a host, or one url, with a third of all pages is spread over many partitions. A rule is
copied only to the partitions its interval meets. A task holds its sorted stream and the stack.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up
to ``?``, ``#`` or the end.

Defined cases: a null url or one without ``://`` has empty host and path and matches no rule. Pages no
rule matches get ``default``. Repeated pages get one row each. Of rules equal in host and path the
blocking one holds; rules with null or empty host are ignored. Empty tables give empty results (no
rules: every page gets the default). Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_PARTITION = 64
MARK = "\x01"   # ends a label in a key
ESCAPE = "\x02"  # starts the pair that stands for a MARK or ESCAPE inside a label

FIXED_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
               ("block", "net/es/"), ("block", "net/fr/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each ended by MARK, which no label holds once it is escaped."""
    safe = F.replace(F.replace(host, F.lit(ESCAPE), F.lit(ESCAPE + "\x03")), F.lit(MARK), F.lit(ESCAPE * 2))
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(safe, r"\.", -1)), MARK), F.lit(MARK)))


def _bounds(points: DataFrame, partitions: int) -> list[str]:
    """Partition bounds from a sample of at most about SAMPLE_PER_PARTITION keys per partition."""
    n = points.count()
    want = partitions * SAMPLE_PER_PARTITION
    rate = max(1, n // want)
    got = sorted(r[0] for r in points.select("key").where(F.pmod(F.xxhash64("key", "page_id"), F.lit(rate)) == 0)
                 .limit(4 * want).collect())
    return sorted({got[len(got) * k // partitions] for k in range(1, partitions)}) if got else []


def _sweep(default: str):
    """Sorted rows (kind 0: rule, 1: page) -> pages with their rule. Rules come before pages of equal key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []  # host key, path -> rule, path lengths
        for b in batches:
            cols = [c.to_pylist() for c in (b.column("kind"), b.column("host_key"), b.column("page_id"),
                                            b.column("host"), b.column("path"), b.column("verdict"))]
            out: list[tuple] = []
            for kind, hk, page, host, path, verdict in zip(*cols):
                while stack and not hk.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != hk:
                        stack.append((hk, {}, []))
                    _, paths, lengths = stack[-1]
                    if paths.get(path, ("", "allow"))[1] != "block":
                        paths[path] = (host + path, verdict)
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best: tuple[int, int, str, str] | None = None
                for depth, (_, paths, lengths) in enumerate(stack):
                    for n in lengths:
                        hit = paths.get(path[:n]) if n <= len(path) else None
                        if hit:
                            best = max(best or (0, -1, "", ""), (len(hit[0]), depth, *hit))
                            break
                out.append((page, host, path, best[2] if best else None, best[3] if best else default))
            if out:
                p, h, q, r, v = zip(*out)
                yield pa.record_batch([pa.array(p, pa.int64()), pa.array(h, pa.string()), pa.array(q, pa.string()),
                                       pa.array(r, pa.string()), pa.array(v, pa.string())],
                                      names=["page_id", "host", "path", "rule", "verdict"])

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", partitions: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url). ``rules`` has verdict
    (allow or block), host and path; it may be of any size."""
    spark = pages.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.col("url").cast("string")
    points = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")) \
        .withColumn("host_key", host_key(F.col("host"))) \
        .withColumn("key", F.concat("host_key", F.lit(MARK), "path", F.lit(MARK), F.coalesce(F.hex("page_id"), F.lit(""))))
    bounds = _bounds(points, partitions)

    @F.pandas_udf("int")
    def partition_of(key):
        return key.map(lambda k: bisect_right(bounds, k)).astype("int32")

    @F.pandas_udf("array<int>")
    def partitions_of(hk):
        # All keys that start with hk lie from hk up to hk + the last code point.
        return hk.map(lambda k: list(range(bisect_right(bounds, k), bisect_left(bounds, k + "\U0010ffff") + 1)))

    marked = rules.select(F.col("verdict"), F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path")) \
        .where("host <> '' and verdict in ('allow', 'block')").distinct().withColumn("host_key", host_key(F.col("host")))
    starts = marked.select(F.explode(partitions_of("host_key")).alias("part"), F.lit(0).alias("kind"), "host_key",
                           F.col("host_key").alias("key"), F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict")
    stream = points.select(partition_of("key").alias("part"), F.lit(1).alias("kind"), "host_key", "key", "page_id", "host",
                           "path", F.lit(None).cast("string").alias("verdict")).unionByName(starts)
    return stream.repartitionById(partitions, "part").sortWithinPartitions("part", "host_key", "kind", "key") \
        .select("kind", "host_key", "page_id", "host", "path", "verdict") \
        .mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")


def rule_table(spark, rules: tuple[tuple[str, str], ...] = FIXED_RULES) -> DataFrame:
    """Rules written as ``host/path`` as a table."""
    rows = [(v, r.split("/", 1)[0], "/" + r.split("/", 1)[1]) for v, r in rules]
    return spark.createDataFrame(rows, "verdict string, host string, path string")
