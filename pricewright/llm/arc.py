"""Legacy ARC archives, and their conversion to WARC.

Archives are written by Spark's text writer, whose line separator is what each format
puts behind a record, and compressed as whole files. They are read back as files, record
by record, by the lengths that their headers declare.
"""

import gzip
import hashlib
import re
import uuid
from base64 import b32encode
from collections.abc import Iterator
from io import BufferedReader, BytesIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .base import ship_package, stage, stage_path
from .phrase_index import _small

#: Records and bytes after which a file is full, bytes of records handed on at once, and the smallest payload that a revisit may stand for.
FILE_RECORDS, FILE_BYTES, BYTES_AT_ONCE, LEAST_PAYLOAD = 4096, 64 << 20, 8 << 20, 100
#: The header lines of the two versions, as the formats define them.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CAPTURED = "20240101000000"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:pricewright:arc")
PAGE_HEADER = b"X-Page-Id"
UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def arc_record(version: int, url: str, content_type: str, body: bytes, date: str = CAPTURED, filename: str = "-") -> bytes:
    """One record without the newline behind it."""
    url = UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) or "-"
    head = f"{url} 0.0.0.0 {date} {content_type} "
    if version == 2:
        head += f"200 - - 0 {filename} "
    return f"{head}{len(body)}\n".encode() + body


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 pricewright\n{FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "text/plain", body, filename=name)


def _arc_lines(file_records: int, file_bytes: int):
    """Records of (part, page_id, url, html) with the number of their file and their place: a version block, then records as long as both bounds allow, one at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place, records, size = -1, 0, file_records, 0

        def table(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64()))], names=["value", "file", "place"])

        for batch in batches:
            out, waiting = [], 0
            for part, page, url, html in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                version, number = 1 + part % 2, b"" if page is None else b"%d" % page
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%b: %b\r\n\r\n" % (PAGE_HEADER, number)
                body = head + (html.as_py() or b"")
                if records >= file_records or size + len(body) > file_bytes and records > 1:
                    file, records, size = file + 1, 0, 0
                name = f"part-{part}-{file}.arc"
                lines = ([version_block(version, name)] if records == 0 else []) + [arc_record(version, url or "-", "text/html", body, filename=name)]
                for line in lines:
                    out.append((line, file, place))
                    place, records, size, waiting = place + 1, records + 1, size + len(line), waiting + len(line)
                if waiting >= BYTES_AT_ONCE:
                    yield table(out)
                    out, waiting = [], 0
            if out:
                yield table(out)
    return run


def _save(lines: DataFrame, path: str, separator: str, *by: str, **options) -> None:
    lines.select(F.col("value").cast("string"), *by).write.option("lineSep", separator).option("compression", "gzip").options(**options).partitionBy(*by).text(path)


def write_arc(pages: DataFrame, path: str, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as ARC files, version 1 or 2 by partition.

    A file holds ``file_records`` records and ``file_bytes`` bytes at most, or a single page that is longer. The pages are not shuffled.
    A null html is an empty body; a null url is written as a dash; null and repeated ids are records of their own.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(F.spark_partition_id().alias("part"), F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary"))
    lines = rows.mapInArrow(_arc_lines(file_records, file_bytes), "value binary, file long, place long")
    _save(lines.sortWithinPartitions("file", "place"), path, "\n", "file")


def _open(content: bytes) -> BufferedReader:
    raw = BytesIO(content)
    return BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if content[:2] == b"\x1f\x8b" else BufferedReader(raw)


def read_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record of a file, the version block first.

    The version block names the fields of the header lines that follow it. A record that is
    shorter than it declares, at the end of a damaged file, has the field ``truncated``.
    """
    stream, fields, offset = _open(content), None, 0
    while True:
        line = stream.readline()
        if not line:
            return
        start, offset = offset, offset + len(line)
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        names = fields or FIELDS[1].split()
        if fields is None and len(text.split(" ")) >= len(FIELDS[2].split()):
            names = FIELDS[2].split()
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no ARC header at byte {start}: {text[:200]!r}")
        header = {n.lower(): v for n, v in zip(names, values)}
        size = int(header["archive-length"])
        block = stream.read(size)
        offset += len(block)
        if len(block) < size:
            header["truncated"] = "length"
        if fields is None:
            if not header["url"].startswith("filedesc:"):
                raise ValueError("an ARC file begins with a version block")
            told = block.decode("utf-8", "replace").split("\n")
            header["version"] = told[0].split(" ")[0]
            fields = told[1].split() if len(told) > 1 and told[1].strip() else FIELDS[int(header["version"])].split()
        yield start, header, block


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header and payload of a block; one that holds no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def page_of(head: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        if line.startswith(PAGE_HEADER + b":"):
            value = line.partition(b":")[2].strip()
            return int(value) if value else None
    return None


def warc_date(arc_date: str) -> str:
    """An ARC date of 8 to 14 digits as WARC writes it; others as the earliest date."""
    digits = re.sub(r"\D", "", arc_date)
    digits = (digits + "000000")[:14] if len(digits) >= 8 else "19700101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(file: str, offset: int) -> str:
    """The identifier of the record at ``offset`` of ``file``; the same whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{file}#{offset}')}>"


def warc_record(file: str, offset: int, header: dict[str, str], block: bytes, original: tuple | None) -> bytes:
    """The WARC record equivalent to an ARC record, without the two newlines behind it.

    ``original`` is (page, file, offset) of the response that has the same payload, if this one revisits it.
    """
    lines = [("WARC-Record-ID", record_id(file, offset)), ("WARC-Date", warc_date(header["archive-date"]))]
    if "version" in header:
        body = f"software: pricewright\r\nformat: WARC File Format 1.1\r\nisPartOf: {header['url']}\r\narc-version: {header['version']}\r\n".encode()
        lines = [("WARC-Type", "warcinfo"), *lines, ("WARC-Filename", header["url"].partition("//")[2]), ("Content-Type", "application/warc-fields")]
    else:
        head, payload = split_http(block)
        kind, body = ("response" if head else "resource"), block
        extra = [("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}")]
        if original is not None:
            # The payload stands in the response, so its length is told here.
            kind, body = "revisit", head
            extra += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*original[1:])), ("X-Refers-To-Page", "" if original[0] is None else str(original[0])),
                      ("X-Payload-Length", str(len(payload)))]
        if "truncated" in header:
            extra.append(("WARC-Truncated", header["truncated"]))
        kind_of = "application/http; msgtype=response" if head else header["content-type"]
        lines = [("WARC-Type", kind), *lines, ("WARC-Target-URI", header["url"]), ("WARC-IP-Address", header["ip-address"]), *extra, ("Content-Type", kind_of)]
    lines += [("WARC-Block-Digest", "sha1:" + b32encode(hashlib.sha1(body).digest()).decode()), ("Content-Length", str(len(body)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode() + body


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a file, by the declared lengths."""
    stream = _open(content)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC header: {line[:200]!r}")
        header = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.lower()] = value.strip()
        size = int(header["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record {header.get('warc-record-id')} is shorter than {size} bytes")
        yield header, block


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    # Files that one task wrote into different folders bear one name.
    return files.select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("file"), "content")


DIGESTS = "file string, offset long, page_id long, digest string, bytes long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for offset, header, block in read_arc(content.as_py()):
                if "version" not in header:
                    head, payload = split_http(block)
                    rows.append((file, offset, page_of(head), hashlib.sha256(payload).hexdigest(), len(payload)))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "offset", "page_id", "digest", "bytes"])


def _converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content, revisits in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            originals = {r["offset"]: (r["page_id"], r["first_file"], r["first_offset"]) for r in revisits or ()}
            lines, size = [], 0
            for offset, header, block in read_arc(content.as_py()):
                lines.append(warc_record(file, offset, header, block, originals.get(offset)))
                size += len(lines[-1])
                if size >= BYTES_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])
                    lines, size = [], 0
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, least_payload: int = LEAST_PAYLOAD, file_records: int = FILE_RECORDS) -> None:
    """Convert the ARC files under one path to WARC files under another.

    Of records with equal payloads of at least ``least_payload`` bytes that with the smallest page, then file and
    offset, is the response, and the others are revisits of it. Which records those are is decided on
    digests; it is handed to a file's conversion as a list no longer than the file.
    """
    ship_package(spark)
    files = _files(spark, arc_path)
    found = stage(files.mapInArrow(_digests, DIGESTS), "arc-digests")
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset")
    firsts = found.where(F.col("bytes") >= least_payload).groupBy("digest", "bytes").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = stage(firsts.where("n > 1").drop("n"), "first-payloads")
    again = found.join(firsts, ["digest", "bytes"]).where((F.col("file") != F.col("first.file")) | (F.col("offset") != F.col("first.offset")))
    entry = F.struct("offset", F.col("first.page_id").alias("page_id"), F.col("first.file").alias("first_file"), F.col("first.offset").alias("first_offset"))
    again = stage(again.groupBy("file").agg(F.collect_list(entry).alias("revisits")), "revisits")
    again = _small(again, F.size("revisits") * 120 + 80)
    joined = files.join(again, "file", "left").select("file", "content", "revisits")
    _save(joined.mapInArrow(_converted, "value binary"), warc_path, "\r\n\r\n", maxRecordsPerFile=file_records)


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, date string"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date"]
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for header, block in read_warc(content.as_py()):
                kind = header["warc-type"]
                if kind == "warcinfo":
                    continue
                head, payload = split_http(block)
                size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                told = header["warc-payload-digest"].partition(":")[2]
                refers = None
                if kind == "revisit":
                    size, digest, page = int(header["x-payload-length"]), told, header["x-refers-to-page"]
                    refers = int(page) if page else None
                elif digest != told:
                    raise ValueError(f"the payload of {header['warc-record-id']} does not match its digest")
                rows.append((page_of(head), header["warc-target-uri"], size, digest, kind, refers, header["warc-record-id"], header["warc-date"]))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the WARC files under ``path``: the page, its payload's size and digest, the record's type and what it refers to."""
    ship_package(spark)
    return _files(spark, path).mapInArrow(_records, RECORDS)


def archive_pages(pages: DataFrame, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` as ARC, convert them to WARC, and read those back: page_id, payload_bytes, payload_digest, record_type and refers_to.

    Null and empty html is an empty payload and always a response. Pages of one id are records each; of equal payloads the smallest id,
    then file and place, is the response, and a null id only if there is no other. A page of any length is one
    record, in a file of its own if it is longer than ``file_bytes``. No pages give no files and no rows.
    """
    spark = pages.sparkSession
    arc, warc = stage_path(spark, "arc"), stage_path(spark, "warc")
    write_arc(pages, arc, file_records, file_bytes)
    convert_arc(spark, arc, warc, file_records=file_records)
    return read_archives(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same rows from the table itself.
ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
"""
