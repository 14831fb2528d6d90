"""Legacy ARC archives: write, parse by declared lengths, convert to WARC, read WARC back."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import new_work_path

ARCHIVE_BYTES = 8 << 20
SMALLEST_REVISIT = 100
#: Effort of compression: against the default, pages take a third of the time and 4 % more room.
LEVEL = "FOUR"

# Fixed values of the two formats: ARC record definitions by version, WARC version and revisit profile.
DEFINITION = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
VERSION_BODY = re.compile(rb"[12] \d+[ \n]")  # version, reserved, origin
WARC_VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Page-Id"

RECORD_SCHEMA = ("record_id string, kind string, uri string, ip string, date string, content_type string, id bigint, "
                 "payload_bytes bigint, digest string, head binary, payload binary")
READ_SCHEMA = "record_id string, kind string, uri string, date string, id bigint, payload_bytes bigint, digest string, refers_to string"


def _blobs(records: Iterable[bytes], first: bytes = b"", sep: bytes = b"") -> Iterator[bytes]:
    """Records joined to archives of about ``ARCHIVE_BYTES``; a record is never cut."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= ARCHIVE_BYTES:
            yield first + sep.join(held)
            held, size = [], 0
    if held:
        yield first + sep.join(held)


def _binary(blobs: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    for blob in blobs:
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["archive"])


def _http(id_: int | None, payload: bytes) -> bytes:
    named = f"{ID_HEADER}: {id_}\r\n" if id_ is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{named}\r\n".encode()


def _arc_uri(url: str | None) -> str:
    """A header field: never empty, without blanks or control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def _arc_writer(date: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for version in DEFINITION:  # alternate rows go to archives of either version
                def records(version: int = version) -> Iterator[bytes]:
                    for row in batch.slice(0).to_pylist()[version - 1::len(DEFINITION)]:
                        payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                        body = _http(row["page_id"], payload) + payload
                        middle = "" if version == 1 else f" 200 {zlib.crc32(body):08x} - 0 pages.arc"
                        yield f"{_arc_uri(row['url'])} 0.0.0.0 {date} text/html{middle} {len(body)}\n".encode() + body
                about = f"{version} 0 corpus\n{DEFINITION[version]}\n".encode()
                middle = "" if version == 1 else " 200 - - 0 pages.arc"
                first = f"filedesc://pages.arc 0.0.0.0 {date} text/plain{middle} {len(about)}\n".encode() + about + b"\n"
                yield from _binary(_blobs(records(), first, b"\n"))
    return write


def write_files(archives: DataFrame, path: str, ending: str) -> None:
    """One compressed file per row of binary ``archive``, its bytes as they are, closed with ``ending``."""
    (archives.select(F.col("archive").cast("string").alias("value")).write.mode("errorifexists")
     .option("lineSep", ending).option("compression", "gzip").option("zlib.compress.level", LEVEL).option("maxRecordsPerFile", 1).text(path))


def write_arc(pages: DataFrame, path: str, date: str = "20250101000000") -> None:
    """Write ``(page_id, url, html)`` as ARC files, versions 1 and 2 in turn.

    A null text is empty, a null or empty URL becomes ``about:blank``, blanks and control characters in URLs are
    percent-encoded, a null id leaves out the id header. An empty table writes no archive. Other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    write_files(rows.mapInArrow(_arc_writer(date), "archive binary"), path, "\n")


def _iso(date: str) -> str:
    """ARC dates have 14 digits, in the oldest files 12 or 8."""
    d = (date + "00000000000000"[len(date):]) if date.isdigit() and 8 <= len(date) <= 14 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def arc_records(data: bytes, name: str) -> Iterator[tuple]:
    """Records of an ARC file, cut by their declared lengths.

    A version block sets the field list of the lines after it, so concatenated archives of different versions read
    right. Bodies that are HTTP messages are split at the blank line; others are resources. A header line with too few
    fields, or a length beyond the file, is an error that names file and offset.
    """
    at, fields = 0, DEFINITION[1].split()
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at:end if end >= 0 else len(data)].decode("utf-8", "replace").split(" ")
        start, length = end + 1, parts[-1]
        # A version block's line is laid out by the version it announces; a page may be called like one, but has no such body.
        about = data.startswith(b"filedesc://", at) and VERSION_BODY.match(data, start)
        if about:
            line = dict(zip(DEFINITION[1].split(), parts, strict=False))
        else:
            if len(parts) != len(fields):
                raise ValueError(f"{name} at {at}: header of {len(parts)} fields, {len(fields)} expected")
            line = dict(zip(fields, parts, strict=True))
            length = line["Archive-length"]
        if end < 0 or not length.isdigit() or start + int(length) > len(data):
            raise ValueError(f"{name} at {at}: length {length!r} does not fit the file")
        body = data[start:start + int(length)]
        id_ = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}#{parts[0]}')}>"
        common = (id_, parts[0], line.get("IP-address", "0.0.0.0"), _iso(line.get("Archive-date", "")), line.get("Content-type", ""))
        if about:
            lines = body.decode("utf-8", "replace").split("\n")
            fields = lines[1].split() if len(lines) > 1 and lines[1].startswith("URL ") else DEFINITION[int(lines[0].split(" ")[0])].split()
            yield (*common, "warcinfo", b"", body)
        elif body.startswith(b"HTTP/") and b"\r\n\r\n" in body:
            cut = body.index(b"\r\n\r\n") + 4
            yield (*common, "response", body[:cut], body[cut:])
        else:
            yield (*common, "resource", b"", body)
        at = start + int(length)


def _unpacked(content: bytes) -> bytes:
    return zlib.decompress(content, 47) if content[:2] == b"\x1f\x8b" else content


def _arc_reader(with_payload: bool):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                out = []
                for id_, uri, ip, date, kind_of, kind, head, payload in arc_records(_unpacked(content.as_py()), path.as_py().rpartition("/")[2]):
                    page = _fields(head).get(ID_HEADER.lower())
                    out.append((id_, kind, uri, ip, date, kind_of, int(page) if page else None, len(payload),
                                hashlib.sha256(payload).hexdigest(), head, payload if with_payload else None))
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.string()] * 6 + [pa.int64()] * 2 + [pa.string()] + [pa.binary()] * 2, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in RECORD_SCHEMA.split(", ")])
    return read


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all ARC files in a folder, one file per row of work; without payloads if only their digests count."""
    return _files(spark, path).mapInArrow(_arc_reader(with_payload), RECORD_SCHEMA)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def originals(records: DataFrame, least: int = SMALLEST_REVISIT) -> DataFrame:
    """``(record_id, of_id, of_uri, of_date)`` of each record whose payload, of ``least`` bytes or more, an earlier one has.

    The original is the record with the smallest id (rows without id last, then by record id). Digests are
    pre-aggregated to one row each before the join, so copies of one payload never pair up.
    """
    large = records.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= least)).select("record_id", "digest", "payload_bytes", "id", "uri", "date")
    first = large.groupBy("digest", "payload_bytes").agg(F.min(F.struct(F.col("id").isNull(), "id", "record_id", "uri", "date")).alias("of"))
    return (large.join(first, ["digest", "payload_bytes"]).filter(F.col("record_id") != F.col("of.record_id"))
            .select("record_id", F.col("of.record_id").alias("of_id"), F.col("of.uri").alias("of_uri"), F.col("of.date").alias("of_date")))


def warc_record(row: dict) -> bytes:
    """One WARC record without its closing blank lines; a revisit keeps the protocol headers and drops the payload."""
    revisit = row["of_id"] is not None
    block = row["head"] if revisit else row["head"] + row["payload"]
    kind = "revisit" if revisit else row["kind"]
    lines = [WARC_VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {row['date']}"]
    if kind == "warcinfo":
        lines += [f"WARC-Filename: {row['uri'].removeprefix('filedesc://')}", "Content-Type: application/warc-fields"]
    else:
        lines += [f"WARC-Target-URI: {row['uri']}", f"WARC-IP-Address: {row['ip']}", f"WARC-Payload-Digest: sha256:{row['digest']}",
                  f"Content-Type: {'application/http; msgtype=response' if row['head'] else row['content_type']}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {row['of_id']}", f"WARC-Refers-To-Target-URI: {row['of_uri']}",
                  f"WARC-Refers-To-Date: {row['of_date']}"]
    lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _warc_writer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[bytes]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield warc_record(batch.slice(i, 1).to_pylist()[0])
    yield from _binary(_blobs(records(), sep=b"\r\n\r\n"))


def arc_to_warc(spark: SparkSession, arc: str, warc: str) -> None:
    """Convert a folder of ARC files to WARC files.

    The first reading takes digests only and finds the revisits; the second carries payloads, joined to the revisits by
    record id, which no two records share, so a payload that a third of all pages repeat skews nothing.
    """
    again = originals(read_arc(spark, arc, with_payload=False))
    records = read_arc(spark, arc).join(again.hint("shuffle_hash"), "record_id", "left")
    write_files(records.mapInArrow(_warc_writer, "archive binary"), warc, "\r\n\r\n")


def warc_records(data: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, cut by Content-Length."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"{name} at {at}: no record header")
        fields = _fields(data[at:end])
        start, length = end + 4, int(fields["content-length"])
        if data[start + length:start + length + 4] != b"\r\n\r\n":
            raise ValueError(f"{name} at {at}: length {length} does not end at a record's end")
        yield fields, data[start:start + length]
        at = start + length + 4


def _bare(digest: str | None) -> str | None:
    return digest.rpartition(":")[2].lower() if digest else None


def _warc_reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            out, name = [], path.as_py().rpartition("/")[2]
            for fields, block in warc_records(_unpacked(content.as_py()), name):
                if _bare(fields.get("warc-block-digest")) != hashlib.sha256(block).hexdigest():
                    raise ValueError(f"{name}: block digest of {fields.get('warc-record-id')} differs")
                http = fields.get("content-type", "").startswith("application/http")
                cut = block.index(b"\r\n\r\n") + 4 if http else 0
                head, payload = _fields(block[:cut]), block[cut:]
                kind, digest, size = fields["warc-type"], _bare(fields.get("warc-payload-digest")), len(payload)
                if kind == "revisit":
                    size = int(head["content-length"])
                elif digest and digest != hashlib.sha256(payload).hexdigest():
                    raise ValueError(f"{name}: payload digest of {fields.get('warc-record-id')} differs")
                page = head.get(ID_HEADER.lower())
                out.append((fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields["warc-date"], int(page) if page else None,
                            size, digest, fields.get("warc-refers-to")))
            if out:
                types = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], [f.split()[0] for f in READ_SCHEMA.split(", ")])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; block digests, and payload digests of all but revisits, are verified while reading."""
    return _files(spark, path).mapInArrow(_warc_reader, READ_SCHEMA)


def archived(records: DataFrame) -> DataFrame:
    """Page rows of ``read_warc``: revisits get the page id of the response they refer to."""
    pages = records.filter(F.col("kind").isin("response", "revisit"))
    targets = pages.filter(F.col("kind") == "response").select(F.col("record_id").alias("refers_to"), F.col("id").alias("of_page"))
    return pages.join(targets, "refers_to", "left").select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.col("of_page").alias("refers_to"))


def page_archive(pages: DataFrame) -> DataFrame:
    """Pages to ARC files, those to WARC files, and these read back; all in the shared folder."""
    spark = pages.sparkSession
    arc, warc = new_work_path(spark, "arc"), new_work_path(spark, "warc")
    write_arc(pages, arc)
    arc_to_warc(spark, arc, warc)
    return archived(read_warc(spark, warc))
