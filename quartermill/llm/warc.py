"""Web archives: records written by Spark's own text writer, and a reader that salvages damaged files.

A record is one row of text and the blank lines that end it are the line separator, so plain archives go
wherever Spark can write, under its commit protocol. The reader checks every record; after a failed
check it looks for the next valid member or version line, goes on there, and logs the bytes between.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.llm.common import text_or_empty
from quartermill.session import materialise

END = "\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_PREFIX = "urn:x-page:"
#: Archives aim at this size; the reader holds one archive at a time.
TARGET_BYTES = 32 << 20
PIECE = 1 << 16


# Writing


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 1000) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)``, one row per page.

    Of equal payloads of at least ``least_bytes`` the one with the largest id is the response that the
    others revisit. Digests are compared, not payloads; a payload shared by many pages is counted
    before it travels, and its rows may be split over many tasks.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(payload).alias("payload"))
    raw = F.col("payload").cast("binary")
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha1(raw)})
    shared = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    shared = materialise(shared, "shared")  # its size is known then, and the payloads travel only if it is large
    rows = rows.join(shared, "payload_digest", "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    return rows.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                       F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def _record_id(column: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_PREFIX}"), F.coalesce(column.cast("string"), F.lit("null")), F.lit(">"))


def records(rows: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The text of each record, without the end that the writer adds."""
    revisit = F.col("record_type") == "revisit"
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(END))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("payload")))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    none = F.lit("")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", target), none),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", _record_id(F.col("refers_to"))))).otherwise(none),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("block").cast("binary")))),
        line("Content-Length", F.octet_length("block")), F.lit("\r\n"))
    return rows.withColumn("block", block).select(F.concat(header, F.col("block")).alias("value"))


def write(rows: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> str:
    """Write rows of ``with_revisits`` as archives of about ``target_bytes`` below ``path``."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes")).first()
    per_file = max(1, target_bytes * size["n"] // (size["bytes"] + 600 * size["n"] + 1)) if size["n"] else 1
    records(rows).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)
    return path


# Reading


@dataclass
class Found:
    """A record, or (``reason``) a gap of bytes that no check accepts."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


class _Damaged(Exception):
    pass


def _record(data: bytes, at: int) -> tuple[Found, int]:
    """The plain record at ``at`` and where the next begins; raises if a check fails."""
    if not VERSION.match(data, at):
        raise _Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise _Damaged("header without end")
    headers = {}
    for text in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = text.partition(b":")
        if not colon:
            raise _Damaged("header line without colon")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise _Damaged("no content length")
    start, end = stop + 4, stop + 4 + int(length)
    if end > len(data):
        raise _Damaged("record is cut off")
    block = data[start:end]
    if not _digest_fits(headers.get("warc-block-digest"), block):
        raise _Damaged("block digest differs")
    if headers.get("warc-type") == "response" and not _digest_fits(headers.get("warc-payload-digest"), payload_of(block)):
        raise _Damaged("payload digest differs")
    if data[end:end + 4] == b"\r\n\r\n":
        end += 4
    elif end != len(data):
        raise _Damaged("record end is missing")
    return Found(at, end - at, None, headers, block), end


def _digest_fits(digest: str | None, data: bytes) -> bool:
    """Only hexadecimal SHA-1 is checked, as the writer gives it; other digests are left alone."""
    if digest is None or not re.fullmatch(r"sha1:[0-9a-f]{40}", digest):
        return True
    return digest[5:] == hashlib.sha1(data).hexdigest()


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header of a block."""
    _, _, payload = block.partition(b"\r\n\r\n")
    return payload


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The unpacked member at ``at`` and where it ends; fed in pieces, as what is left over is copied."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        piece = data[at:at + PIECE]
        if not piece:
            raise _Damaged("member is cut off")
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error as error:
            raise _Damaged("member can't be unpacked") from error
        at += len(piece)
    return b"".join(parts), at - len(unpack.unused_data)


def salvage(data: bytes) -> Iterator[Found]:
    """All valid records of an archive, plain or packed in members, and a gap for every stretch between them."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                plain, after = _member(data, at)
                found, inner = [], 0
                while inner < len(plain):
                    one, inner = _record(plain, inner)
                    found.append(Found(at, after - at, None, one.headers, one.block))
            else:
                one, after = _record(data, at)
                found = [one]
        except _Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            version = VERSION.search(data, at + 1)
            places = [p for p in (data.find(MEMBER, at + 1), version.start() if version else -1) if p >= 0]
            at = min(places, default=len(data))
            continue
        if gap is not None:
            yield Found(gap, at - gap, reason)
            gap = None
        yield from found
        at = after
    if gap is not None:
        yield Found(gap, len(data) - gap, reason)


SCHEMA = ("file string, offset bigint, length bigint, reason string, record_type string, record_id string, target_uri string, "
          "refers_to string, payload_digest string, payload_bytes bigint")


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records and gaps of all archives below ``path``; ``reason`` is null for records.

    ``payload_bytes`` is the length of the payload, which a revisit names in its HTTP header. With
    ``payload``, the payload itself follows. An empty or unreadable archive gives no records, and the
    latter one gap. Archives are read whole, one at a time.
    """

    def rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                made, size = [], 0
                for found in salvage(bytes(content)):
                    made.append(_row(name, found, payload))
                    size += found.length
                    if size > 8 << 20:
                        yield pd.DataFrame(made, columns=columns)
                        made, size = [], 0
                if made:
                    yield pd.DataFrame(made, columns=columns)

    schema = SCHEMA + (", payload binary" if payload else "")
    columns = [part.split()[0] for part in schema.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, schema)


def _row(name: str, found: Found, payload: bool) -> tuple:
    if found.reason is not None:
        return (name, found.offset, found.length, found.reason, *[None] * (7 if payload else 6))
    h = found.headers
    content = payload_of(found.block) if h.get("warc-type") == "response" else b""
    size = len(content)
    if h.get("warc-type") == "revisit":
        named = re.search(rb"(?i)\r\ncontent-length: *(\d+)", found.block)
        size = int(named[1]) if named else 0
    row = (name, found.offset, found.length, None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"),
           h.get("warc-refers-to"), h.get("warc-payload-digest"), size)
    return (*row, content) if payload else row


def page_number(column: str) -> Column:
    """The page id inside a record id; null for a page without one."""
    return F.regexp_extract(column, rf"^<{RECORD_PREFIX}(-?\d+)>$", 1).try_cast("bigint")


def archive_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write one record per page below ``path`` and read the archives back: one row per record.

    Columns ``page_id, payload_bytes, payload_digest, record_type, refers_to``. A null payload counts as
    empty; empty and short payloads are always responses. Pages with a null id are never referred to; if
    all pages of a payload lack one, all are responses. Repeated rows give repeated records of one id, and
    those that share the largest id are all responses. An empty table gives no rows.
    """
    write(with_revisits(pages, page_id, url, payload), path)
    return read(pages.sparkSession, path).filter("reason IS NULL").select(
        page_number("record_id").alias("page_id"), "payload_bytes", F.regexp_extract("payload_digest", "^sha1:(.*)$", 1).alias("payload_digest"),
        "record_type", page_number("refers_to").alias("refers_to"))


SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM f"""
