"""WARC archives written and read through Spark, with a salvaging reader.

An archive is a run of gzip members, one record each.  Tasks build archives of
bounded size; Spark's text writer stores each as one file (the bytes of a
string column are written as they are, and the NUL behind the last member is
padding that gzip readers skip), so any file system that Spark writes to will
do.  ``binaryFile`` reads them back.

The reader checks each member (gzip, version line, Content-Length, digests of
block and payload).  Where a check fails it searches for the next valid gzip
member or plain version line, goes on from there, and reports the bytes between
as a quarantined gap.  A member's content is searched for version lines alike,
and that of a damaged member as far as it inflates.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custval.operators.joins import hot_from_counts, join_hot
from custval.operators.persist import materialize

VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP, _VERSION = b"\x1f\x8b\x08", re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = re.compile(re.escape(_GZIP) + rb"|WARC/1\.[01]\r\n")
#: fields that every record has once
_ONCE = {"warc-record-id", "warc-type", "warc-date", "content-length"}
#: field of a record saved from a damaged member, with what is wrong there: its block is sound, its headers may not be
SAVED = "saved-from"
#: step in which members are inflated
_PIECE = 1 << 15

RECORDS = ("archive string, start long, end long, kind string, reason string, record_id string, record_type string, "
           "target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary")
_RECORDS = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("reason", pa.string()),
                      ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> bytes:
    """A header value on one line: control characters become spaces."""
    return re.sub(rb"[\x00-\x1f\x7f]", b" ", value.encode())


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that refers to the record that has it."""
    block = payload if refers_to is None else b""
    head = [VERSION, b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
            b"WARC-Record-ID: <" + _line(record_id) + b">", b"WARC-Date: " + date.encode(),
            *([b"WARC-Target-URI: " + _line(uri)] if uri is not None else []),
            b"WARC-Payload-Digest: sha1:" + digest(payload).encode(), b"WARC-Payload-Length: %d" % len(payload),
            b"WARC-Block-Digest: sha1:" + digest(block).encode(),
            *([b"WARC-Refers-To: <" + _line(refers_to) + b">", b"WARC-Profile: " + PROFILE] if refers_to is not None else []),
            b"Content-Type: application/octet-stream", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(records: DataFrame, path: str, archive_bytes: int = 16 << 20, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write (record_id string, uri string, payload binary, refers_to string) as archives of about ``archive_bytes``.

    A null payload is empty, a null uri is left out.  Repeated rows are
    repeated records.  An empty table gives a folder without archives.
    """
    def build(batches):
        parts, size = [], 0
        for batch in batches:
            for rid, uri, payload, refers in zip(*(batch[c].to_pylist() for c in ("record_id", "uri", "payload", "refers_to"))):
                parts.append(member(record(rid, uri, payload or b"", refers, date)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pa.record_batch({"archive": pa.array([b"".join(parts)], pa.binary())})
                    parts, size = [], 0
        if parts:
            yield pa.record_batch({"archive": pa.array([b"".join(parts)], pa.binary())})

    (records.select("record_id", "uri", "payload", "refers_to").mapInArrow(build, "archive binary")
     .select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path))


@dataclass
class Failure:
    """What is wrong at a place, and the records that can be had there all the same."""

    reason: str
    saved: list = field(default_factory=list)


def _parse(data: bytes, pos: int) -> tuple[dict, bytes, int] | Failure:
    """(fields, block, end) of the plain record at ``pos``, or what is wrong with it."""
    if not _VERSION.match(data, pos):
        return Failure("no version line")
    fields, end = {}, data.find(b"\r\n", pos)
    while True:                                       # a header may be of any length; its first bad line ends the search
        begin, end = end + 2, data.find(b"\r\n", end + 2)
        if end < 0:
            return Failure("header not ended")
        if begin == end:
            break
        name, colon, value = data[begin:end].partition(b":")
        if not colon:
            return Failure("header line without a colon")
        name = name.strip().lower().decode("latin-1")
        if name in _ONCE and name in fields:          # a header cut off and another record's behind it
            return Failure("header field repeated")
        fields[name] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        return Failure("no Content-Length")
    begin, size = end + 2, int(fields["content-length"])
    if data[begin + size: begin + size + 4] != b"\r\n\r\n":
        return Failure("Content-Length does not fit")
    block = data[begin: begin + size]
    said = "sha1:" + digest(block)
    if fields.get("warc-block-digest", said) != said:
        return Failure("block digest differs")
    if fields.get("warc-type") == "response" and fields.get("warc-payload-digest", said) != said:
        return Failure("payload digest differs")
    return fields, block, begin + size + 4


def _inflate(data: bytes, pos: int) -> tuple[bytes, int, str | None]:
    """(content, end, what is wrong) of the gzip member at ``pos``, fed in pieces; of a damaged one all that comes before the fault."""
    z, out, view, begin = zlib.decompressobj(31), [], memoryview(data), pos
    try:
        while not z.eof:
            piece = view[pos: pos + _PIECE]
            if not len(piece):
                return b"".join(out), pos, "gzip: cut off"
            out.append(z.decompress(piece))
            pos += len(piece)
        return b"".join(out), pos - len(z.unused_data), None
    except zlib.error as e:
        reason, fault = f"gzip: {e}"[:80], pos
    z, out = zlib.decompressobj(31), []                   # again, byte by byte where the fault is
    try:
        while begin < len(data):
            step = _PIECE if begin < fault else 1
            out.append(z.decompress(view[begin: begin + step]))
            begin += step
    except zlib.error:
        pass
    return b"".join(out), begin, reason


def _scan(data: bytes, read, starts: re.Pattern) -> Iterator[tuple[int, int, str | None, object]]:
    """(start, end, reason, found) of what ``read`` accepts (reason None) and of the gaps between, in order.

    ``read(data, pos)`` gives a tuple that ends in the end, or a failure;
    behind a failure it is tried wherever ``starts`` matches.  What a failure
    has saved comes before its gap, with the start of its place and the gap's end.
    """
    pos, n = 0, len(data)
    while pos < n:
        if data[pos] == 0:                            # padding between members
            pad = re.compile(rb"\x00+").match(data, pos)
            pos = pad.end()
            continue
        begin, found, reason, saved = pos, read(data, pos), None, []
        while isinstance(found, Failure):
            reason = reason or found.reason
            saved += [(pos, found.saved)] if found.saved else []
            nxt = starts.search(data, pos + 1)
            pos = nxt.start() if nxt else n
            found = read(data, pos) if nxt else None
        for start, inside in saved:
            yield start, pos, None, (inside, pos)
        if reason is not None:
            yield begin, pos, reason, None
        if found is not None:
            yield pos, found[-1], None, found
            pos = found[-1]


def _at(data: bytes, pos: int) -> tuple[list, int] | Failure:
    """([(reason, fields, block)], end) of the member or plain record at ``pos``, or what is wrong with it.

    A member has any number of records, and gaps (with a reason) between them,
    but at least one record.  From a damaged member the records whose block
    digest holds are saved.
    """
    if not data.startswith(_GZIP, pos):
        found = _parse(data, pos)
        return found if isinstance(found, Failure) else ([(None, *found[:2])], found[2])
    content, end, wrong = _inflate(data, pos)
    inside = [(reason, *(found[:2] if found else ({}, b""))) for _, _, reason, found in _scan(content, _parse, _VERSION)]
    if wrong:
        return Failure(wrong, [(None, f | {SAVED: wrong}, block) for bad, f, block in inside if bad is None and "warc-block-digest" in f])
    if all(reason for reason, _, _ in inside):
        return Failure(inside[0][0] if inside else "no version line")
    return inside, end


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict, bytes]]:
    """(start, end, reason, fields, block) of each record (reason None) and each quarantined gap of an archive, in order.

    The records and gaps inside a gzip member all have the member's start and end.
    """
    for start, end, reason, found in _scan(data, _at, _MEMBER):
        for inner, fields, block in (found[0] if found else [(reason, {}, b"")]):
            yield start, end, inner, fields, block


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives under ``path``.

    ``kind`` is ``record`` or ``gap`` (with its ``reason`` and byte range);
    ``payload_digest`` and ``payload_bytes`` are those of the full payload,
    for revisits as their headers say.  Every byte of an archive but NUL
    padding is in a record or gap; those inside one gzip member share its
    range, and records saved from a damaged member (only such with a block
    digest that holds) lie within the gap that reports it and have its reason,
    as no digest covers their headers.
    """
    def read(batches):
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                rows, size = [], 0
                for start, end, reason, f, block in salvage(data):
                    sha = f.get("warc-payload-digest", "")
                    revisit = f.get("warc-type") == "revisit"
                    length = f.get("warc-payload-length", "") if revisit else str(len(block))
                    rows.append((name, start, end, "record" if reason is None else "gap", reason or f.get(SAVED), _bare(f.get("warc-record-id")), f.get("warc-type"),
                                 f.get("warc-target-uri"), sha.removeprefix("sha1:") or (None if reason or revisit else digest(block)),
                                 int(length) if length.isdigit() and reason is None else None, _bare(f.get("warc-refers-to")),
                                 block if payloads and reason is None else None))
                    size += len(block)
                    if size > 1 << 22 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORDS.types)], schema=_RECORDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORDS.types)], schema=_RECORDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(read, RECORDS)


def deduplicated_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                         min_payload: int = 0) -> DataFrame:
    """Records for ``write_archives``: of equal payloads of at least ``min_payload`` bytes the smallest id is the response.

    The others refer to it.  Rows that share an id and payload share a record
    id and are all responses if theirs is the smallest; a null id sorts behind
    all others and is written as ``null``; a null payload is empty.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(uri_col).cast("string").alias("uri"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    key = F.sha2("payload", 256)
    firsts = materialize(rows.where(F.octet_length("payload") >= min_payload).select("id", key.alias("sha"))
                         .groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    keyed = rows.withColumn("sha", F.when(F.octet_length("payload") >= min_payload, key))
    # payloads that very many pages share are dealt out; so are small ones, which have no key
    hot = hot_from_counts(firsts, ["sha"], "n", pages.count(), always_null=min_payload > 0)
    return (join_hot(keyed, firsts.drop("n"), ["sha"], "left", hot, salt_by=["id", "uri"])
            .select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("record_id"), "uri", "payload",
                    F.when(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.col("first").cast("string")).alias("refers_to")))
