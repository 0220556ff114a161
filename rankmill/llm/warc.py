"""Legacy archive converter: ARC files to WARC files.

An ARC file opens with a version block (`filedesc://`), whose first number tells how the header
lines of the records behind it are built: version 1 has five fields, version 2 ten. The last field
is the declared length of the block that follows. The converter cuts records by that length, never
by separators, and makes the WARC record of each: identifier from page, URL and date, ISO timestamp,
type, payload digest. A version block becomes a `warcinfo` record that the records of its file refer to, an
HTTP block a response, any other block (dns, ftp) a resource. Of responses with equal payloads of at least
`MIN_SHARED` bytes the one with the smallest page id stays and the others are revisits that carry no payload.

Both archives are written by Spark's text writer, whose line separator is the end mark of a record,
gzipped as a whole, `RECORDS` records a file; so files are committed with their job and can be read whole.
Records are bytes from end to end: a column of text hands its bytes to the writer as they are, whatever
their encoding. Files are read back as binary files.

A header line that can't be read, or a length beyond the end of the file, costs that record only: reading
goes on at the next line that is a header, and `bad_records` lists what was passed over.

Equal payloads that are a third of all pages cost one row per map task where the smallest page id is
looked for; the join behind it has plain exchanges on both sides, which adaptive execution splits.
Null html is an empty payload; a null page id stays null and never counts as the smallest while
there is another; rows that repeat the smallest page id are all responses. White space and control
characters in a URL are percent-encoded, as are bytes beyond ASCII. Payloads may have any length below 2 GB
and any bytes (`html` may be text or binary); an empty table gives empty archives and no rows; further
columns of the pages are not read, so they may have any name.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.llm.common import LAST_ID, ship_package, stored
from rankmill.session import fresh_dir

MIN_SHARED = 100
RECORDS = 256
CAPTURED = "20240101000000"
URL_SAFE = "".join(map(chr, range(33, 127)))

# fixed values: the header lines of the two ARC versions
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
LONGEST_HEADER = 1 << 16
HTTP_ENDS = (b"\r\n\r\n", b"\n\n")
PARSED = "kind string, arc string, page_id bigint, url string, ip string, captured string, head binary, payload binary, payload_bytes bigint, digest string, at bigint, error string"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, captured string, record_id string, payload binary"


# -- ARC ----------------------------------------------------------------------------------


def version_block(version: int, name: str) -> str:
    body = f"{version} 0 rankmill\n{ARC_FIELDS[version]}\n"
    middle = "text/plain" if version == 1 else "text/plain 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {CAPTURED} {middle} {len(body)}\n{body}"


def arc_head(version: int, page_id: int | None, url: str | None, size: int) -> str:
    """Header line and HTTP head of a record whose payload has `size` bytes."""
    number = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}\r\n"
    address = quote(url or "unknown:", safe=URL_SAFE)
    middle = "text/html" if version == 1 else "text/html 200 - - 0 pages"
    return f"{address} 0.0.0.0 {CAPTURED} {middle} {len(http) + size}\n{http}"


def arc_record(version: int, page_id: int | None, url: str | None, html: str | None) -> str:
    return arc_head(version, page_id, url, len((html or "").encode("utf-8"))) + (html or "")


def _write_records(records: DataFrame, path: str, rows_per_file: int, end: str, level: str = "DEFAULT_COMPRESSION") -> None:
    """Writes a column of bytes, `end` behind each; text is not looked into on its way to the file."""
    (
        records.select(F.col("value").cast("string"))
        .write.option("maxRecordsPerFile", rows_per_file)
        .option("compression", "gzip")
        .option("zlib.compress.level", level)
        .option("lineSep", end)
        .text(path)
    )


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages to ARC files; versions alternate from file to file."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                version = 1 + done // RECORDS % 2
                if done % RECORDS == 0:
                    rows.append(version_block(version, f"pages-{task}-{done // RECORDS}.arc").encode())
                payload = html or b""
                rows.append(arc_head(version, page_id, url, len(payload)).encode() + payload)
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    payload = F.col("html").cast("binary")
    table = pages.select(F.col("page_id").cast("long"), "url", payload).mapInArrow(blocks, "value binary")
    # the version block is one row more, so each file opens with one; these files are read twice and
    # then superseded
    _write_records(table, path, RECORDS + 1, "\n", "BEST_SPEED")


def arc_header(line: bytes, names: list[str]) -> dict[str, str] | None:
    """The named fields of a header line; None if it is none. What is too much belongs to the URL."""
    parts = line.rstrip(b"\r").rsplit(b" ", max(len(names), 2) - 1)
    if line.startswith(b"filedesc://"):
        parts, names = [line.split(b" ", 1)[0], parts[-1]], ["URL", "Archive-length"]
    if not names or len(parts) != len(names) or not parts[-1].isdigit():
        return None
    fields = {"URL": quote(parts[0], safe=URL_SAFE)}
    fields |= {name: part.decode("latin-1") for name, part in zip(names[1:], parts[1:], strict=True)}
    date = fields.get("Archive-date", "0000")
    return fields if date.isdigit() and 4 <= len(date) <= 14 else None


def arc_entries(data: bytes, on_error: Callable[[int, str], None]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an ARC file, version blocks too: named header fields and the block of declared
    length. A record that can't be read is told to `on_error`; the next header line follows."""
    at, names, lost = 0, [], False
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at : min(end, at + LONGEST_HEADER)]
        fields = arc_header(line, names)
        if lost and (fields is None or b":" not in line):
            at = end + 1
            continue
        length = int(fields["Archive-length"]) if fields else 0
        block = data[end + 1 : end + 1 + length]
        reason = None
        if fields is None:
            reason = f"no header of {len(names)} fields" if names else "no version block"
        elif len(block) != length:
            reason = f"record at byte {at} is cut off: {len(block)} of {length} bytes"
        elif line.startswith(b"filedesc://"):
            version = block.split(b" ", 1)[0]
            if version not in (b"1", b"2"):
                reason = f"unknown version {version[:20]!r}"
            else:
                names = ARC_FIELDS[int(version)].split(" ")
        if reason:
            on_error(at, reason)
            at, lost = end + 1, True
            continue
        at, lost = end + 1 + length, False
        yield fields, block


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a faultless ARC file without its version blocks."""

    def fail(at: int, reason: str) -> None:
        raise ValueError(f"byte {at}: {reason}")

    return (entry for entry in arc_entries(data, fail) if not entry[0]["URL"].startswith("filedesc://"))


def unzipped(content: bytes) -> bytes:
    return zlib.decompress(content, 47) if content[:2] == b"\x1f\x8b" else content


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its end mark, and payload."""
    ends = sorted((block.find(mark), len(mark)) for mark in HTTP_ENDS if mark in block)
    cut = sum(ends[0]) if ends else len(block)
    return block[:cut], block[cut:]


def parsed_arc(content: bytes) -> list[dict]:
    """Rows of one ARC file: its records, and with `error` set what could not be read."""
    rows: list[dict] = []
    arc = None
    try:
        data = unzipped(content)
    except zlib.error as fault:
        return [{"at": 0, "error": f"not to be unzipped: {fault}"}]
    for fields, block in arc_entries(data, lambda at, reason: rows.append({"at": at, "error": reason})):
        row = {"url": fields["URL"], "ip": fields.get("IP-address"), "captured": fields.get("Archive-date", CAPTURED)}
        if fields["URL"].startswith("filedesc://"):
            arc = fields["URL"]
            rows.append(row | {"kind": "warcinfo", "arc": arc, "payload": block})
            continue
        response = block.startswith(b"HTTP/")
        head, payload = split_http(block) if response else (b"", block)
        number = header_of(head, b"X-Page-Id") or ""
        rows.append(
            row
            | {
                "kind": "response" if response else "resource",
                "arc": arc,
                "page_id": int(number) if number.removeprefix("-").isdecimal() else None,
                "head": head,
                "payload": payload,
                "payload_bytes": len(payload),
                "digest": hashlib.sha256(payload).hexdigest(),
            }
        )
    return rows


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield pa.RecordBatch.from_pylist(parsed_arc(content.as_py()), schema=_arrow(PARSED))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, PARSED)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """One row per ARC record, its HTTP head apart from the payload."""
    return _parsed(spark, path).filter("error IS NULL").drop("at", "error")


def bad_records(spark: SparkSession, path: str) -> DataFrame:
    """(at, error) of each place below a folder of ARC files that could not be read."""
    return _parsed(spark, path).filter("error IS NOT NULL").select("at", "error")


def header_of(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip().decode("latin-1")
    return None


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


# -- WARC ---------------------------------------------------------------------------------


def record_identifier(page_id: int | None, url: str, captured: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {captured} {url}')}>"


def iso_time(captured: str) -> str:
    """Archive date to WARC date; older dates may lack their last fields."""
    full = captured.ljust(14, "0") if len(captured) >= 8 else (captured + "0101")[:8].ljust(14, "0")
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def info_identifier(arc: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, arc)}>"


def info_record(row: dict) -> bytes:
    """The `warcinfo` record of a version block."""
    version = row["payload"].split(b" ", 1)[0].decode("latin-1")
    block = f"software: rankmill\r\nformat: WARC File Format 1.0\r\ndescription: from {row['arc']}, ARC version {version}\r\n"
    lines = [
        "WARC/1.0",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: {info_identifier(row['arc'])}",
        f"WARC-Date: {iso_time(row['captured'])}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n" + block).encode()


def warc_record(row: dict) -> bytes:
    """WARC bytes of one parsed ARC record; `first_page` is set where it revisits another page."""
    if row["kind"] == "warcinfo":
        return info_record(row)
    revisit = row["first_page"] is not None
    block = row["head"] if revisit else row["head"] + row["payload"]
    kind, content = "resource", "text/dns" if row["url"].startswith("dns:") else "application/octet-stream"
    if row["kind"] == "response":
        kind, content = "revisit" if revisit else "response", "application/http; msgtype=response"
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_identifier(row['page_id'], row['url'], row['captured'])}",
        f"WARC-Date: {iso_time(row['captured'])}",
        f"WARC-Target-URI: {row['url']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"Content-Type: {content}",
    ]
    if row["arc"] is not None:
        lines.append(f"WARC-Warcinfo-ID: {info_identifier(row['arc'])}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_identifier(row['first_page'], row['first_url'], row['first_captured'])}",
            f"X-Refers-To-Page-Id: {row['first_page']}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Converts every ARC file below one folder to WARC files below another."""
    parsed = read_arc(spark, arc_path)
    number = F.coalesce("page_id", F.lit(LAST_ID))
    firsts = stored(
        parsed.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= MIN_SHARED))
        .groupBy("digest")
        .agg(F.min(F.struct(number.alias("id"), "url", "captured")).alias("first")),
        "warc-firsts",
    )
    revisits = (F.col("kind") == "response") & (F.col("first.id") < number) & F.col("first").isNotNull()
    marked = parsed.join(firsts, "digest", "left").select(
        *parsed.columns,
        F.when(revisits, F.col("first.id")).alias("first_page"),
        F.col("first.url").alias("first_url"),
        F.col("first.captured").alias("first_captured"),
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [warc_record(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    _write_records(marked.mapInArrow(records, "value binary"), warc_path, RECORDS, WARC_END)


def warc_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record, cut by `Content-Length`."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC header at byte {at}")
        length = int(header_of(head, b"Content-Length"))
        block = data[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError(f"record at byte {at} is cut off: {len(block)} of {length} bytes")
        yield head, block
        at = end + 4 + length + len(WARC_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record. The digest of every payload that is there is computed anew and compared."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in warc_records(unzipped(content.as_py())):
                    kind, digest = header_of(head, b"WARC-Type"), header_of(head, b"WARC-Payload-Digest")
                    http, payload = split_http(block) if kind in ("response", "revisit") else (b"", block)
                    number, refers = header_of(http, b"X-Page-Id") or "", header_of(head, b"X-Refers-To-Page-Id")
                    if kind in ("response", "resource") and digest != f"sha256:{hashlib.sha256(payload).hexdigest()}":
                        raise ValueError(f"payload and digest differ: {header_of(head, b'WARC-Record-ID')}")
                    rows.append(
                        {
                            "page_id": int(number) if number.removeprefix("-").isdecimal() else None,
                            "payload_bytes": int(header_of(head, b"X-Payload-Length") or len(payload)),
                            "payload_digest": digest and digest.removeprefix("sha256:"),
                            "record_type": kind,
                            "refers_to": None if refers is None else int(refers),
                            "url": header_of(head, b"WARC-Target-URI"),
                            "captured": header_of(head, b"WARC-Date"),
                            "record_id": header_of(head, b"WARC-Record-ID"),
                            "payload": None if kind == "revisit" else payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(READ))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, READ)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages through ARC to WARC in the shared folder and back: the rows of `read_warc` that are pages."""
    spark = pages.sparkSession
    ship_package(spark)
    arc, warc = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    write_arc(pages, arc)
    arc_to_warc(spark, arc, warc)
    return read_warc(spark, warc).filter(F.col("record_type") != "warcinfo")
