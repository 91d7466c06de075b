"""Legacy archive converter: ARC records to WARC, and WARC read back (operator 2).

An ARC archive starts with a version block (``filedesc://``) whose second line names
version 1 or 2 and whose third line lists the fields of the header lines that follow:

    1: URL IP-address Archive-date Content-type Archive-length
    2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset
       Filename Archive-length

``parse_arc`` takes header lines by the version's fields and bodies by declared length.
``convert`` makes the WARC records: a record id from the ARC record's URL, date and digest
(name-based UUID), an ISO timestamp from the 14 digits, type ``response`` (or ``revisit``
where an equal, larger payload was seen), SHA-1 block and payload digests (base 32).

Archives are written with Spark's text writer (a record a value, the blank lines after a
record as the line separator), so they go to any file system Spark reaches, and read with
its binary-file reader, one archive a row.  A file ends after a number of records that the
mean and largest payload give (``records_a_file``): about ``ARCHIVE_BYTES`` and surely less
than ``LARGEST_ARCHIVE`` unzipped, however large a partition is.  ``read_warc`` parses by Content-Length and checks digests.

Which records are revisits: payloads of at least ``REVISIT_BYTES`` bytes are grouped by
digest; the largest page id is the response.  Records are dealt by digest for that, small
ones by page, so a page that is a third of the crawl meets one winner row in a join that
adaptive execution splits.

Defined results: null html is an empty payload; a null url is ``urn:page:<id>``, characters
that would break a header line are percent-encoded; a null page id is kept, as null, and
is the smallest; rows that repeat a page id are records of their own (all rows with the
largest id are responses); an empty table makes no archive and gives an empty result.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
LARGEST_ARCHIVE = 1 << 30  # an archive is read as one value, which must stay below 2 GiB
HEAD_BYTES = 1_500  # room for the headers of a record
# fixed values: field names of the two ARC versions
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
END = "\r\n\r\n"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, warc_date string, record_id string"


# ------------------------------------------------------------------ ARC
@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    body: bytes
    extra: dict


def arc_archive(name: str, version: int, records: list[tuple[str, str, str, str, bytes]]) -> bytes:
    """An ARC archive of (url, ip, 14-digit date, content type, body)."""
    head = f"{version} 0 sparkfeat\n{FIELDS[version]}\n\n".encode()
    middle = " 200 - - 0 " + name if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 20000101000000 text/plain{middle} {len(head)}\n".encode(), head, b"\n"]
    offset = sum(map(len, out))
    for url, ip, date, kind, body in records:
        middle = f" 200 {hashlib.md5(body).hexdigest()} - {offset} {name}" if version == 2 else ""
        line = f"{url} {ip} {date} {kind}{middle} {len(body)}\n".encode()
        out += [line, body, b"\n"]
        offset += len(line) + len(body) + 1
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an archive, by the fields of its own version block."""
    first = data.index(b"\n")
    line = data[:first].decode()
    if not line.startswith("filedesc://"):
        raise ValueError("an ARC archive starts with a filedesc block")
    size = int(line.rsplit(" ", 1)[1])
    block = data[first + 1:first + 1 + size].decode().split("\n")
    version = int(block[0].split(" ")[0])
    if version not in FIELDS:
        raise ValueError(f"ARC version {version}")
    names = block[1].split(" ")
    at = first + 1 + size
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):  # blank lines between records
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode().rstrip("\r").split(" ")
        if len(values) != len(names):
            raise ValueError(f"{len(values)} fields where version {version} has {len(names)}")
        field = dict(zip(names, values))
        size = int(field["Archive-length"])
        body = data[end + 1:end + 1 + size]
        if len(body) != size:
            raise ValueError("an ARC body is shorter than its declared length")
        yield ArcRecord(field["URL"], field["IP-address"], field["Archive-date"], field["Content-type"], body, field)
        at = end + 1 + size


# ------------------------------------------------------------------ WARC
def split_http(body: bytes) -> tuple[bytes, bytes]:
    """The HTTP head, with its blank line, and the payload."""
    end = body.find(b"\r\n\r\n")
    return (body[:end + 4], body[end + 4:]) if body.startswith(b"HTTP/") and end >= 0 else (b"", body)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_id(url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest}')}>"


def warc_date(date: str) -> str:
    d = (date + "00000000000000")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def convert(r: ArcRecord, refers: tuple[str, str, int] | None = None) -> bytes:
    """One WARC record without the blank lines after it; ``refers`` (url, date, page) of
    the response that a revisit stands for."""
    head, payload = split_http(r.body)
    digest = _digest(payload)
    block = head if refers else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}",
             f"WARC-Record-ID: {warc_id(r.url, r.date, digest)}", f"WARC-Date: {warc_date(r.date)}",
             f"WARC-Target-URI: {r.url}", f"WARC-IP-Address: {r.ip}",
             f"WARC-Payload-Digest: {digest}", f"WARC-Block-Digest: {_digest(block)}"]
    if refers:
        url, date, page = refers
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {warc_id(url, date, digest)}", f"WARC-Refers-To-Target-URI: {url}",
                  f"WARC-Refers-To-Date: {warc_date(date)}", f"X-Refers-To-Page: {page}"]
    kind = "application/http; msgtype=response" if head else r.content_type
    lines += [f"Content-Type: {kind}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of every record, by Content-Length."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError("a WARC record starts with its version")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")[1:]
        field = dict(x.split(": ", 1) for x in lines)
        size = int(field["Content-Length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a WARC block does not end where its length says")
        yield field, block
        at = end + 8 + size


# ------------------------------------------------------------------ Spark
def safe_uri(url: Column, page: Column) -> Column:
    """A url that holds no white space or control characters (percent-encoded)."""
    out = F.coalesce(url, F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("null"))))
    for i in (*range(0x21), 0x7F):
        out = F.replace(out, F.lit(chr(i)), F.lit(f"%{i:02X}"))
    return F.when(out == "", F.lit("urn:page:empty")).otherwise(out)


def arc_date(page: Column) -> Column:
    """Pages hold no date; one second a page from 2000-01-01, as 14 digits."""
    return F.date_format(F.timestamp_seconds(F.lit(946_684_800) + F.pmod(F.coalesce(page, F.lit(0)), F.lit(3_000_000_000))),
                         "yyyyMMddHHmmss")


def as_arc(pages: DataFrame) -> DataFrame:
    """(archive binary, refers): ARC archives of a few pages each, the two versions in
    turn; refers: for each record the (url, date, page) it revisits, or null."""
    def run(batches):
        n = 0
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                records, refers, size = [], [], 0
                while at < len(rows) and size < 4 << 20:
                    r = rows[at]
                    payload = r["html"] or b""
                    page = "" if r["page_id"] is None else r["page_id"]
                    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            f"X-Page-Id: {page}\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
                    records.append((r["uri"], "0.0.0.0", r["date"], "text/html", head + payload))
                    refers.append(r["refers"])
                    size += len(payload)
                    at += 1
                n += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([arc_archive(f"pages-{n}.arc", 1 + n % 2, records)], pa.binary()),
                     pa.array([refers], pa.list_(pa.struct([("uri", pa.string()), ("date", pa.string()), ("page_id", pa.int64())])))],
                    ["archive", "refers"])
    return pages.select("page_id", "uri", "date", "html", "refers").mapInArrow(
        run, "archive binary, refers array<struct<uri:string,date:string,page_id:long>>")


def arc_to_warc(archives: DataFrame) -> DataFrame:
    """(record): WARC records of ARC archives (archive binary, refers array or null)."""
    def run(batches):
        for batch in batches:
            for data, refers in zip(batch.column(0), batch.column(1)):
                refers = refers.as_py()
                out = []
                for i, r in enumerate(parse_arc(data.as_py())):
                    to = refers[i] if refers else None
                    out.append(convert(r, (to["uri"], to["date"], to["page_id"]) if to else None))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return archives.select("archive", "refers").mapInArrow(run, "record binary")


def records_a_file(payload_bytes: Column, pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Records for an archive of about ``archive_bytes`` unzipped: by the mean size, and few
    enough that even the largest records together stay below ``LARGEST_ARCHIVE``."""
    size = F.coalesce(payload_bytes, F.lit(0)).cast("double") + HEAD_BYTES
    mean, most = pages.agg(F.avg(size), F.max(size)).first()
    return max(1, int(min(archive_bytes // (mean or 1), LARGEST_ARCHIVE // (most or 1))))


def write_warc(records: DataFrame, path: str, per_file: int = 0) -> str:
    """Gzip archives of the records, of ``per_file`` records at most (0: one a partition)."""
    (records.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))
    return path


def read_warc(spark, path: str) -> DataFrame:
    """A row for each record of the archives under ``path``; digests are checked."""
    import zlib

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                data = data.as_py()
                if name.as_py().endswith(".gz"):
                    data = zlib.decompress(data, 31)
                rows = {k.split(" ")[0]: [] for k in RESULT.split(", ")}
                for field, block in parse_warc(data):
                    head, payload = split_http(block)
                    digest = field["WARC-Payload-Digest"]
                    revisit = field["WARC-Type"] == "revisit"
                    if _digest(block) != field["WARC-Block-Digest"] or not revisit and _digest(payload) != digest:
                        raise ValueError(f"a digest is wrong in {field['WARC-Record-ID']}")
                    page = re.search(rb"\r\nX-Page-Id: (-?\d+)", head)
                    length = re.search(rb"\r\nContent-Length: (\d+)", head)
                    to = field.get("X-Refers-To-Page")
                    for k, v in zip(rows, (int(page[1]) if page else None, int(length[1]) if length else len(payload),
                                           base64.b32decode(digest[5:]).hex(), field["WARC-Type"],
                                           int(to) if to and to != "None" else None, field["WARC-Target-URI"],
                                           field["WARC-Date"], field["WARC-Record-ID"])):
                        rows[k].append(v)
                kinds = {"long": pa.int64(), "string": pa.string()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[k], kinds[t]) for k, t in (x.split(" ") for x in RESULT.split(", "))], list(rows))

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content"))
    return files.mapInArrow(run, RESULT)


def archive_pages(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write a WARC record per page through ARC archives; equal payloads become revisits.
    A WARC file holds about ``archive_bytes``, whatever the partitions hold."""
    html = F.col("html").cast("string").cast("binary")
    page = F.col("page_id").cast("long")
    rows = pages.select(page.alias("page_id"), safe_uri(F.col("url").cast("string"), page).alias("uri"),
                        arc_date(page).alias("date"), html.alias("html"))
    big = F.coalesce(F.octet_length("html"), F.lit(0)) >= REVISIT_BYTES
    rows = rows.withColumn("key", F.when(big, F.sha1("html")).otherwise(
        F.concat(F.lit("small"), F.xxhash64("page_id", "uri").cast("string"))))
    first = (rows.where(big).groupBy("key").agg(F.max(F.struct("page_id", "uri", "date")).alias("first"))
             .select("key", "first"))
    rows = rows.join(first, "key", "left").withColumn("refers", F.when(
        F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id")),
        F.struct(F.col("first.uri").alias("uri"), F.col("first.date").alias("date"), F.col("first.page_id").alias("page_id"))))
    return write_warc(arc_to_warc(as_arc(rows)), path, records_a_file(F.octet_length(html), pages, archive_bytes))


def op2_arc_to_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = archive_pages(pages, scratch_path(spark, "warc"))
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                  sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN p.n >= 1000 AND p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN p.n >= 1000 AND p.page_id <> f.first THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 1000
"""
