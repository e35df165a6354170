"""Legacy archives to WARC: ARC files of version 1 and 2 are read by their header lines and declared
lengths, and equivalent WARC records are synthesised.

* :func:`write_arc` stores pages as ARC files (each starts with a ``filedesc`` record that states the
  version), written by Spark's text writer, so commits and lost executors are Spark's business.
* :func:`read_arc` parses ARC files record by record. The version block of a file names its version;
  version 1 lines are ``url ip date type length``, version 2 lines ``url ip date type status checksum
  location offset file length``. Payloads are cut by the declared length, never by content. Fields are
  taken from the right, so an url may hold blanks.
* :func:`arc_rejects` lists what could not be read, with the reason: a damaged header line (reading goes on
  at the next line that is a header), a record cut short, a file without a version block.
* :func:`write_warc` writes WARC/1.0 files: of records with equal payloads of ``min_revisit`` bytes or
  more, the one with the largest page id is a ``response``, the others are ``revisit`` records that
  refer to it; all smaller ones are responses. Ids come from page id and digest, times from the ARC date,
  digests are SHA-1 (base32, as WARC has it).
* :func:`read_warc` parses the files back by ``Content-Length``.

A record's separator, two line ends, is the text writer's line separator, so a part file is a WARC file.
Archives are read as a stream inside a task: memory holds one compressed file and one record.

Defined cases: a null html is an empty payload; a null url is ``unknown:``; blanks and control characters
of urls are percent-encoded. Repeated pages are records like others; with equal large payloads and one
page id each is the response. Null page ids stay null and lose to any id. Empty tables give no
records. Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.store import fresh, small_batches, written

MIN_REVISIT = 1000
ARC_DATE = "20240101000000"
BROADCAST_IDS = 4_000_000
BATCH_BYTES = 4 << 20
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of UUIDs
# Fixed format texts of the two ARC versions.
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


class Record(NamedTuple):
    url: str
    date: str
    mime: str
    block: bytes


class Damaged(NamedTuple):
    line: str
    reason: str


def _escape(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else "unknown:"


def _http(page_id: int | None, payload_length: int) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=UTF-8", f"Content-Length: {payload_length}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    return ("\r\n".join(head) + "\r\n\r\n").encode()


def _http_parts(block: bytes) -> tuple[int | None, int, bytes]:
    """(page id, declared payload length, payload) of an HTTP block."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    length = _number(fields.get("Content-Length"))
    return _number(fields.get("X-Page-Id"), signed=True), len(payload) if length is None else length, payload


def _number(text: str | None, signed: bool = False) -> int | None:
    """A decimal of at most 18 digits; null for all else."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}" if signed else r"[0-9]{1,18}", text) else None


# ---------------------------------------------------------------- ARC
def arc_record(version: int, url: str, date: str, mime: str, block: bytes, offset: int, name: str) -> bytes:
    line = f"{url} 0.0.0.0 {date} {mime} "
    line += f"{len(block)}" if version == 1 else f"200 {hashlib.md5(block).hexdigest()} - {offset} {name} {len(block)}"
    return line.encode() + b"\n" + block


def arc_start(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 legacy\n{V1_FIELDS if version == 1 else V2_FIELDS}\n\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain " + ("" if version == 1 else f"200 - - 0 {name} ")
    return line.encode() + str(len(body)).encode() + b"\n" + body


def _header(line: bytes, fields: int) -> tuple[Record, int] | str:
    """(record without its block, length) of a header line of so many fields, or what is wrong with it."""
    f = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", fields - 1)
    if len(f) != fields or not f[0]:
        return "not a header line"
    length = _number(f[-1])
    if length is None:
        return "the length is not a number"
    if not re.fullmatch(r"[0-9]{4,14}", f[2]):
        return "the date is not a number"
    return Record(_escape(f[0]), f[2], f[3], b""), length


def arc_parts(stream) -> Iterator[Record | Damaged]:
    """Records of one ARC stream and what could not be read, in order. After a damaged header line, lines
    are skipped up to the next that is a header; a stream that breaks (gzip) ends the file there."""
    line = b""
    try:
        line = stream.readline()
        head = _header(line, 5 if len(line.split(b" ")) == 5 else 10)
        if isinstance(head, str) or not line.startswith(b"filedesc://"):
            if line:
                yield Damaged(_shown(line), "an ARC file starts with a filedesc record")
            return
        start = stream.read(head[1])
        version = _number(start.split(b" ", 1)[0].decode("utf-8", "replace"))
        if len(start) != head[1] or version not in (1, 2):
            yield Damaged(_shown(line), "cut short" if len(start) != head[1] else "unknown ARC version")
            return
        skipping = False
        while line := stream.readline():
            if line in (b"\n", b"\r\n"):
                continue
            head = _header(line, 5 if version == 1 else 10)
            if isinstance(head, str):
                if not skipping:
                    yield Damaged(_shown(line), head)
                skipping = True
                continue
            skipping = False
            block = stream.read(head[1])
            if len(block) != head[1]:
                yield Damaged(_shown(line), "shorter than its declared length")
                return
            yield head[0]._replace(block=block)
    except (EOFError, OSError, zlib.error) as e:
        yield Damaged(_shown(line), f"the stream breaks off: {type(e).__name__}")


def _shown(line: bytes) -> str:
    return line[:200].decode("utf-8", "replace").rstrip("\r\n")


def arc_records(stream) -> Iterator[Record]:
    """Records of one ARC stream. Raises ValueError where :func:`arc_parts` finds damage."""
    for part in arc_parts(stream):
        if isinstance(part, Damaged):
            raise ValueError(f"{part.reason}: {part.line[:80]!r}")
        yield part


def _arc_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    version, name, offset = 1 + part % 2, f"part-{part:05d}.arc", 0
    for b in batches:
        out, held = [], 0
        for page, url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            payload = (html.as_py() or "").encode()
            if not offset:
                out.append(arc_start(version, name, ARC_DATE))
                offset = len(out[0]) + 1
            rec = arc_record(version, _escape(url), ARC_DATE, "text/html", _http(page, len(payload)) + payload, offset, name)
            offset += len(rec) + 1
            held += len(rec)
            out.append(rec)
            if held > BATCH_BYTES:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files (gzip) of ``pages`` (page_id, url, html); versions alternate by file."""
    pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")) \
        .mapInArrow(_arc_lines, "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary") \
        .load(path).select("path", "content")


def _open(content: bytes):
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


ARC_SCHEMA = "page_id long, url string, date string, mime string, payload binary, digest string"


def _arc_rows(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "date", "mime", "payload", "digest"]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
        for b in batches:
            for content in b.column(1):
                rows, held = [], 0
                for r in arc_parts(_open(content.as_py())):
                    if isinstance(r, Damaged):
                        continue
                    page, _, payload = _http_parts(r.block)
                    digest = hashlib.sha1(payload).hexdigest()
                    rows.append((page, r.url, r.date, r.mime, payload, digest) if payloads else (page, len(payload), digest))
                    held += len(payload) if payloads else 64
                    if held > BATCH_BYTES:
                        yield _batch(rows, names, types) if payloads else _batch(rows, ["page_id", "n", "digest"], _INDEX)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, types) if payloads else _batch(rows, ["page_id", "n", "digest"], _INDEX)

    return run


_INDEX = [pa.int64(), pa.int64(), pa.string()]


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, date, mime, payload, digest) of every record of the ARC files under ``path`` that can
    be read; :func:`arc_rejects` has the rest."""
    return _files(spark, path).mapInArrow(_arc_rows(True), ARC_SCHEMA)


def _damaged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            rows = [(path, *d) for d in arc_parts(_open(content.as_py())) if isinstance(d, Damaged)]
            if rows:
                yield _batch(rows, ["path", "line", "reason"], [pa.string()] * 3)


def arc_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, reason) of what the ARC files under ``path`` hold and :func:`read_arc` cannot read."""
    return _files(spark, path).mapInArrow(_damaged_rows, "path string, line string, reason string")


# ---------------------------------------------------------------- WARC
def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}:{digest}')}>"


def warc_time(date: str) -> str:
    """ISO time of a 14-digit ARC date; shorter dates are filled up with the first moment."""
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return head.encode() + b"\r\n" + block


def warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of one WARC stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC version line: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8").rstrip("\r\n").partition(": ")
            fields[k] = v
        length = int(fields["Content-Length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a WARC record is shorter than its declared length")
        yield fields, block


def _warc_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, date, mime, payload, digest, refers) -> WARC records."""
    first = True
    for b in batches:
        out, held = [], 0
        for page, url, date, _, payload, digest, refers, revisit in zip(*[c.to_pylist() for c in b.columns]):
            if first:
                out.append(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(page, "info" + digest)),
                                        ("WARC-Date", warc_time(date)), ("Content-Type", "application/warc-fields")],
                                       b"format: WARC File Format 1.0\r\n"))
                first = False
            fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, digest)),
                      ("WARC-Target-URI", url), ("WARC-Date", warc_time(date)),
                      ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
            block = _http(page, len(payload))
            if revisit:
                fields += [("WARC-Refers-To", record_id(refers, digest)),
                           ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")]
            else:
                block += payload
            rec = warc_record([*fields, ("Content-Type", "application/http; msgtype=response")], block)
            out.append(rec)
            held += len(rec)
            if held > BATCH_BYTES:
                yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], names=["value"])


def write_warc(spark: SparkSession, arc_path: str, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Convert the ARC files under ``arc_path`` to WARC files (gzip) under ``path``."""
    index = written(_files(spark, arc_path).mapInArrow(_arc_rows(False), "page_id long, n long, digest string"), "arc-index")
    large = index.where(F.col("n") >= min_revisit)
    heads = large.groupBy("digest").agg(F.max("page_id").alias("refers"), F.count("*").alias("c")).where("c > 1")
    small = heads.count() <= BROADCAST_IDS
    heads = heads.select("digest", "refers")
    rows = read_arc(spark, arc_path).join(F.broadcast(heads) if small else heads, "digest", "left") \
        .select("page_id", "url", "date", "mime", "payload", "digest", "refers",
                (F.col("refers").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("refers")))).alias("revisit"))
    rows.mapInArrow(_warc_lines, "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "refers_id", "record_type", "page_id", "payload_bytes", "payload_digest", "url", "date"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for b in batches:
        for content in b.column(1):
            rows = []
            for f, block in warc_records(_open(content.as_py())):
                if f["WARC-Type"] not in ("response", "revisit"):
                    continue
                page, length, payload = _http_parts(block)
                said = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if f["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != said or len(payload) != length):
                    raise ValueError(f"{f['WARC-Record-ID']}: the payload does not fit its digest or length")
                rows.append((f["WARC-Record-ID"], f.get("WARC-Refers-To"), f["WARC-Type"], page, length, said,
                             f["WARC-Target-URI"], f["WARC-Date"]))
                if len(rows) >= 10_000:
                    yield _batch(rows, names, types)
                    rows = []
            if rows:
                yield _batch(rows, names, types)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, refers_id, record_type, page_id, payload_bytes, payload_digest, url, date) of every
    response and revisit under ``path``; payloads are checked against their digests."""
    return _files(spark, path).mapInArrow(
        _warc_rows, "record_id string, refers_id string, record_type string, page_id long, payload_bytes long, "
                    "payload_digest string, url string, date string")


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per page, from the WARC files that
    the pages' ARC files were converted to."""
    spark = pages.sparkSession
    small_batches(spark)
    arc, warc = fresh(spark, "arc"), fresh(spark, "warc")
    write_arc(pages, arc)
    write_warc(spark, arc, warc, min_revisit)
    rows = written(read_warc(spark, warc), "warc-rows")
    heads = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"),
                                                          F.col("page_id").alias("refers_to")) \
        .join(rows.select("refers_id").where("refers_id is not null").distinct(), "refers_id", "left_semi").distinct()
    return rows.join(heads, "refers_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
