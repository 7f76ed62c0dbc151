"""WARC archives: writing with revisit records, and a salvage reader.

The writer is Spark's text sink: each record is a string and the record separator is the
sink's line separator, so archives land wherever Spark can write. The reader takes files
through Spark's binary source; when a record fails its checks it searches for the next
valid gzip member or version line, goes on from there, and reports the bytes passed over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm.common import BROADCAST_ROWS, in_arrow, written

MIN_REVISIT_BYTES = 100  # fixed value of the contract: smaller payloads are always responses
FILE_BYTES = 16 << 20  # of an archive file at most, unless one record is larger
SIZE_STEP = 8  # records are written by classes of size, each this many times the one before
END = "\r\n\r\n"
HEAD_BYTES = 700  # of a record without its payload and its url, at most

MANDATORY = ("warc-type", "warc-record-id", "content-length")  # fixed value
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


def record_types(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with raw (payload bytes), digest, refers_to."""
    raw = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", raw.alias("raw"))
    with_digest = rows.withColumn("digest", F.sha2("raw", 256))
    copies = written(
        with_digest.where(F.octet_length("raw") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .where("first_id < last_id")
        .select("digest", "first_id"),
        "warc-copies",
    )
    if copies.count() <= BROADCAST_ROWS // 8:  # 40-odd bytes a row
        copies = F.broadcast(copies)
    refers = F.when(F.col("page_id") > F.col("first_id"), F.col("first_id"))
    return with_digest.join(copies, "digest", "left").select("page_id", "url", "raw", "digest", refers.alias("refers_to"))


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of `pages` (page_id, url, html) under `path`.

    Of rows with equal payloads of at least 100 bytes, that with the smallest page_id is a
    response and the others revisit it; smaller payloads are all responses. Null html is an
    empty payload, a null url leaves the target out, rows without page_id are responses
    named `null`, and rows that repeat the smallest page_id are all responses.
    """
    rows = record_types(pages)
    level = F.ceil(F.log(float(SIZE_STEP), F.greatest(F.octet_length("raw"), F.lit(1)) / SIZE_STEP**3)).cast("int")
    level = F.greatest(level, F.lit(0))
    sizes = pages.select(F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("raw"))
    largest = sizes.groupBy(level.alias("level")).agg(F.max(F.octet_length("raw"))).collect()  # a dozen rows at most
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("raw").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("raw").cast("string")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:x-page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", "[\\x00-\\x20]", "%20")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.coalesce(
            F.concat(
                F.lit("\r\nWARC-Refers-To: <urn:x-page:"),
                F.col("refers_to").cast("string"),
                F.lit(f">\r\nWARC-Profile: {PROFILE}"),
            ),
            F.lit(""),
        ),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    head_bytes = F.octet_length(F.coalesce(F.col("url"), F.lit("")))
    urls = pages.agg(F.max(head_bytes)).first()[0] or 0
    for at, most in sorted(largest) or [(0, 0)]:
        of_level = rows.where(level == at).select(F.concat(head, block).alias("value"))
        per_file = max(1, FILE_BYTES // (most + 3 * urls + HEAD_BYTES))  # a blank of a url becomes three bytes
        of_level.write.mode("append").option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


class Found(NamedTuple):
    """A record or, with `gap` set, quarantined bytes; offsets are in the (member's) file."""

    offset: int
    length: int
    gap: str | None = None
    headers: dict | None = None
    payload: bytes = b""
    payload_bytes: int = 0


_START = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n|\x1f\x8b\x08")
_BLANK = re.compile(rb"\r?\n\r?\n")  # the end of a header; some writers use bare line feeds
_ENDS = re.compile(rb"\r\n\r\n|\n\n")
FEED = 1 << 14  # bytes at a time from a member, so what follows it is not copied
PIECE = 1 << 12  # from a member that does not decompress as a whole
HEADER_BYTES = 1 << 20  # of a header; one that is not closed by then is damaged
_NUMBER = re.compile(r"\d+")


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """(name, value) of the lines after the first; a line without a colon has no name."""
    parts = (x.rpartition(":") if ":" not in x else x.partition(":") for x in re.split("\r?\n", raw.decode("utf-8", "replace"))[1:])
    return [(k.strip().lower(), v.strip()) for k, _, v in parts]


def _agrees(said: str, data: bytes) -> bool | None:
    """Whether `data` has the digest said (hexadecimal or base32), None if that cannot be told."""
    name, _, value = said.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip()
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512") or not value:
        return None
    digest = hashlib.new(name, data, usedforsecurity=False).digest()
    return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def _unchunked(payload: bytes) -> bytes:
    """A payload sent in chunks, put together; what is no chunk ends it."""
    out, at = [], 0
    while found := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(payload, at):
        size = int(found[1], 16)
        out.append(payload[found.end() : found.end() + size])
        at = found.end() + size + 2
        if not size:
            break
    return b"".join(out)


def _parse(data: bytes, at: int) -> Found | str:
    """The record at `at`, or what is wrong with it."""
    closed = _BLANK.search(data, at, at + HEADER_BYTES)
    if not closed:
        return "header not closed"
    fields = _fields(data[at : closed.start()])
    headers, names = dict(fields), [k for k, _ in fields]
    # A header cut off runs into the next record's: a line without a name, or a field twice.
    if "" in names or any(names.count(k) != 1 for k in MANDATORY):
        return "malformed header"
    if not _NUMBER.fullmatch(headers.get("content-length", "")):
        return "no content length"
    first, last = closed.end(), closed.end() + int(headers["content-length"])
    if last > len(data):
        return "block truncated"
    stop = _ENDS.match(data, last)
    if not stop:
        return "no record end"
    block = data[first:last]
    payload, size, http = block, len(block), {}
    revisit = headers.get("warc-type") == "revisit"
    if headers.get("content-type", "").startswith("application/http"):
        cut = _BLANK.search(block)
        if not cut:
            return "http header not closed"
        payload, size = block[cut.end() :], len(block) - cut.end()
        http = dict(_fields(block[: cut.start()]))
        if revisit:
            said = http.get("content-length", "")
            size = int(said) if _NUMBER.fullmatch(said) else 0
    if _agrees(headers.get("warc-block-digest", ""), block) is False:
        return "block digest differs"
    # A segment's payload digest is that of the whole payload, a revisit's of another record's.
    said = "" if revisit or "warc-segment-number" in headers else headers.get("warc-payload-digest", "")
    if _agrees(said, payload) is False:
        chunked = "chunked" in http.get("transfer-encoding", "").lower()
        if not (chunked and _agrees(said, _unchunked(payload))):
            return "payload digest differs"
    return Found(at, stop.end() - at, headers=headers, payload=payload, payload_bytes=size)


def _inflate(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What the gzip member at `at` holds and where it ends, None if the bytes end first."""
    member, view, out = zlib.decompressobj(31), memoryview(data), []
    while at < len(data) and not member.eof:
        out.append(member.decompress(view[at : at + FEED]))
        at += FEED
    return b"".join(out), min(at, len(data)) - len(member.unused_data) if member.eof else None


def _before_damage(data: memoryview) -> bytes:
    """What a gzip member that does not decompress as a whole gives before its damage."""
    member, out = zlib.decompressobj(31), []
    for lo in range(0, len(data), PIECE):
        spare = member.copy()
        try:
            out.append(member.decompress(data[lo : lo + PIECE]))
        except zlib.error:
            try:
                for i in range(lo, min(lo + PIECE, len(data))):
                    out.append(spare.decompress(data[i : i + 1]))
            except zlib.error:
                break
    return b"".join(out)


def _checked(f: Found) -> bool:
    """Whether a digest speaks for the record's bytes."""
    return any(_agrees(f.headers.get(k, ""), b"") is not None for k in ("warc-block-digest", "warc-payload-digest"))


def _at(data: bytes, at: int) -> tuple[list[Found], int | None, str | None] | str:
    """What starts at `at`: the records of a gzip member or one plain record, and the end; or
    what is wrong. A damaged member has no end, but what is wrong and the records before.

    Of a truncated member all whole records count that other bytes follow; one that ends
    with the bytes would need the member's checksum. Bytes may go wrong before decompression
    fails, so of a member with wrong bytes the records with a digest do."""
    if data[at : at + 3] == b"\x1f\x8b\x08":
        try:
            (inner, end), why = _inflate(data, at), "gzip member truncated"
        except zlib.error as e:
            inner, why = _before_damage(memoryview(data)[at:]), f"gzip member: {e}"[:80]
            got = [f for f in salvage(inner) if not f.gap and _checked(f)]
            return (got, None, why) if got else why
        if end is None:
            got = [f for f in salvage(inner) if not f.gap and f.offset + f.length < len(inner)]
            return (got, None, why) if got else why
        return [f._replace(offset=at, length=end - at) for f in salvage(inner)], end, None
    got = _parse(data, at)
    return got if isinstance(got, str) else ([got], at + got.length, None)


def salvage(data: bytes) -> Iterator[Found]:
    """Records and quarantined gaps of an archive, in order; together they cover every byte.
    The gap of a damaged member covers the member, also where records of it were read."""
    at, got = 0, None
    while at < len(data):
        if got is None:
            got = _at(data, at) if _START.match(data, at) else "no version line or member"
        if not isinstance(got, str) and got[1] is not None:
            yield from got[0]
            at, got = got[1], None
            continue
        records, why = ([], got) if isinstance(got, str) else (got[0], got[2])
        nxt, got = at, None
        while got is None or isinstance(got, str):
            again = _START.search(data, nxt + 1)
            nxt = again.start() if again else len(data)
            if not again:
                break
            got = _at(data, nxt)
        yield from (f._replace(offset=at, length=nxt - at) for f in records)
        yield Found(at, nxt - at, gap=why)
        if nxt == len(data):
            return
        at = nxt


READ = (
    "path string, offset long, length long, gap string, record_id string, record_type string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, payload binary"
)


def _reader(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                out = []
                for f in salvage(content.as_buffer().to_pybytes()):
                    h = f.headers or {}
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
                    if h.get("warc-type") != "revisit" and f.headers is not None:
                        digest = hashlib.sha256(f.payload).hexdigest()
                    out.append(
                        (
                            path.as_py(), f.offset, f.length, f.gap, h.get("warc-record-id"), h.get("warc-type"),
                            h.get("warc-refers-to"), h.get("warc-target-uri"),
                            None if f.gap else f.payload_bytes, None if f.gap else digest,
                            f.payload if with_payload and not f.gap else None,
                        )
                    )
                for lo in range(0, len(out), 4096):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out[lo : lo + 4096]), _TYPES)], names=_NAMES
                    )

    return run


_NAMES = [x.split()[0] for x in READ.split(", ")]
_TYPES = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in READ.split(", ")]


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives under `path`, and a row with `gap` (the reason) for every
    quarantined byte range. Payload digests are recomputed from the bytes read; a revisit's
    are those of the payload that it refers to. An empty folder gives no rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return in_arrow(files, _reader(with_payload), READ)


def archived_pages(records: DataFrame) -> DataFrame:
    """Per record read: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, 'urn:x-page:([-0-9]+)', 1) AS BIGINT)")
    return records.where("gap IS NULL").select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )
