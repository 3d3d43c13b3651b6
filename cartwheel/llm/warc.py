"""Legacy web archives: ARC version 1 and 2 records in, WARC 1.1 records out.

An ARC file starts with a ``filedesc:`` record that names its version; each
record is a header line of space-separated fields (5 in version 1, 10 in
version 2), the declared number of bytes, and a line feed. The converter reads
header lines by the version of their file, takes exactly the declared bytes, and
makes WARC records of them: identifiers (UUID of the record's content and
place), ISO timestamps, types, and SHA-256 digests. Of records with one payload
the first by id becomes the response, the others revisit it.

Archives are written by Spark's file writers, so a lost executor's part is
written anew and nothing half-written is read. An archive holds ARCHIVE_BYTES of
records at most, or one longer record, so that it is read in bounded memory.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import in_batches, scratch, stored

# Fixed values of the two formats.
ARC_FIELDS = {1: ("url", "ip", "date", "mime", "length"), 2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length")}
ARC_TITLES = {1: b"URL IP-address Archive-date Content-type Archive-length", 2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 100
BROADCAST_REVISITS = 50_000
ARCHIVE_BYTES = 32 << 20
ID_HEADER = b"X-Archive-Id"
NO_ID = b"-"
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


class ArcRecord(NamedTuple):
    version: int
    fields: dict[str, str]
    block: bytes


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The record an ARC file opens with."""
    body = b"%d 0 cartwheel\n%s\n" % (version, ARC_TITLES[version])
    values = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "mime": "text/plain", "status": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name, "length": str(len(body))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_record(version: int, block: bytes, **values: str) -> bytes:
    values |= {"length": str(len(block))}
    return " ".join(re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), values.get(f, "-")) or "-" for f in ARC_FIELDS[version]).encode() + b"\n" + block


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file without its version block; header lines are read by the version it names."""
    view, at, version = memoryview(content), 0, 0
    while at < len(content):
        end = content.index(b"\n", at)
        line = content[at:end].decode()
        at = end + 1
        if not line.strip():
            continue
        values = line.split(" ")
        length = int(values[-1])
        if not version:  # only the first record of a file is its version block
            if not line.startswith("filedesc:"):
                raise ValueError(f"an ARC file begins with its version block, not with {line[:200]}")
            version = int(content[at : content.index(b" ", at)])
        else:
            if len(values) != len(ARC_FIELDS[version]):
                raise ValueError(f"an ARC {version} header line has {len(ARC_FIELDS[version])} fields, not {len(values)}: {line[:200]}")
            yield ArcRecord(version, dict(zip(ARC_FIELDS[version], values, strict=True)), bytes(view[at : at + length]))
        at += length


def split_http(block: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Header fields and body of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:]), body


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def parse_warc(content: bytes) -> Iterator[WarcRecord]:
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        headers = dict(x.split(": ", 1) for x in content[at:end].decode().split("\r\n")[1:])
        length = int(headers["Content-Length"])
        yield WarcRecord(headers, content[end + 4 : end + 4 + length])
        at = end + 4 + length + 4


def record_id(page_id: int | None, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def in_archives(records: Iterable[bytes], separator: bytes, most_bytes: int, head: bytes | None = None) -> Iterator[tuple[bytes]]:
    """Whole archives, each begun with ``head``: records up to ``most_bytes`` together, or one longer record."""
    held, size = [], 0
    for record in records:
        if held and size + len(record) > most_bytes:
            yield (separator.join(held if head is None else [head, *held]),)
            held, size = [], 0
        held.append(record)
        size += len(record)
    if held:
        yield (separator.join(held if head is None else [head, *held]),)


def write_archives(archives: DataFrame, separator: str, folder: str) -> None:
    """Each row of the binary column ``record`` as a file of its own."""
    archives.select(F.col("record").cast("string")).write.option("lineSep", separator).option("maxRecordsPerFile", 1).options(**_GZIP).text(folder)


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for content in batch.column("content"):
            yield gzip.decompress(content.as_buffer())


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Pages as ARC archives of bounded size under ``folder/v1`` and ``folder/v2``, half of the ids each."""
    schema = pa.schema([("record", pa.binary())])
    date = "20200101000000"

    def render(version: int):
        def run(batches):
            def rows():
                for batch in batches:
                    for i, url, html in zip(batch.column("i").to_pylist(), batch.column("url").to_pylist(), batch.column("html").cast(pa.large_binary()), strict=True):
                        body = html.as_py() or b""
                        key = NO_ID if i is None else b"%d" % i
                        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%s: %s\r\nContent-Length: %d\r\n\r\n" % (ID_HEADER, key, len(body))
                        yield arc_record(version, head + body, url=url or "-", ip="0.0.0.0", date=date, mime="text/html", status="200")

            block = arc_version_block(version, f"pages-v{version}.arc", date)
            yield from in_batches(in_archives(rows(), b"\n", archive_bytes, block), schema)

        return run

    rows = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    for version in (1, 2):
        own = rows.filter(F.coalesce(F.pmod("i", F.lit(2)), F.lit(0)) == version - 1)
        write_archives(own.mapInArrow(render(version), "record binary"), "\n", f"{folder}/v{version}")


def read_arc(spark: SparkSession, *folders: str) -> DataFrame:
    """``page_id, url, date, mime, body, digest`` of every record of the archives."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("body", pa.binary()), ("digest", pa.string())])

    def run(batches):
        def rows():
            for content in _unpacked(batches):
                for r in parse_arc(content):
                    http, body = split_http(r.block)
                    key = http.get(ID_HEADER, NO_ID)
                    yield None if key == NO_ID else int(key), r.fields["url"], r.fields["date"], r.fields["mime"], body, hashlib.sha256(body).hexdigest()

        yield from in_batches(rows(), schema)

    files = spark.read.format("binaryFile").load(list(folders))
    return files.select("content").mapInArrow(run, "page_id long, url string, date string, mime string, body binary, digest string")


def arc_to_warc(spark: SparkSession, arc_folders: list[str], warc_folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Convert ARC archives to WARC archives with response and revisit records."""
    digests = read_arc(spark, *arc_folders).select("page_id", "digest", F.octet_length("body").alias("n"), "url")
    digests = stored(digests, "arc-digests")
    firsts = digests.filter(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")).alias("f"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1").select(F.col("digest").alias("first_digest"), F.col("f.page_id").alias("first_id"), F.col("f.url").alias("first_url"))
    # a revisit is known by its id; records without one are told by their url
    revisits = digests.join(firsts, (F.col("digest") == F.col("first_digest")) & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = revisits.select(F.col("page_id").alias("re_id"), F.col("digest").alias("re_digest"), "first_id", "first_url").distinct()
    revisits = stored(revisits, "revisits")
    if revisits.count() <= BROADCAST_REVISITS:  # some hundred bytes each; beyond that the payloads are shuffled
        revisits = F.broadcast(revisits)
    records = read_arc(spark, *arc_folders).join(revisits, F.col("page_id").eqNullSafe(F.col("re_id")) & (F.col("digest") == F.col("re_digest")), "left")
    schema = pa.schema([("record", pa.binary())])

    def run(batches):
        def rows():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "date", "mime", "body", "digest", "re_digest", "first_id", "first_url")]
                for i, url, date, mime, body, digest, again, first, first_url in zip(*columns, strict=True):
                    iso = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
                    key = "-" if i is None else str(i)
                    headers = {"WARC-Type": "response", "WARC-Record-ID": record_id(i, digest, url), "WARC-Target-URI": url, "WARC-Date": iso, "WARC-Payload-Digest": f"sha256:{digest}"}
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\n{ID_HEADER.decode()}: {key}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                    if again is not None:
                        headers |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(first, digest, first_url), "WARC-Refers-To-Target-URI": first_url, "X-Refers-To-Id": "-" if first is None else str(first)}
                        body = b""
                    block = head + body
                    headers |= {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": "application/http;msgtype=response"}
                    yield warc_record(headers, block)

        yield from in_batches(in_archives(rows(), b"\r\n\r\n", archive_bytes), schema)

    write_archives(records.mapInArrow(run, "record binary"), "\r\n\r\n", warc_folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, record_type, record_id, url, payload_bytes, payload_digest, payload, refers_to`` of every record.

    The digest of a response is taken anew from its payload and must equal its
    header. A revisit has no payload of its own; its digest and size are its header's.
    """
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("refers_to", pa.int64())])

    def run(batches):
        def rows():
            for content in _unpacked(batches):
                for r in parse_warc(content):
                    http, body = split_http(r.block)
                    digest, kind = r.headers["WARC-Payload-Digest"].removeprefix("sha256:"), r.headers["WARC-Type"]
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"payload digest differs in {r.headers['WARC-Record-ID']}")
                    number = lambda x: None if x in (None, "-", b"-") else int(x)
                    yield number(http[ID_HEADER]), kind, r.headers["WARC-Record-ID"], r.headers["WARC-Target-URI"], int(http[b"Content-Length"]), digest, body, number(r.headers.get("X-Refers-To-Id"))

        yield from in_batches(rows(), schema)

    files = spark.read.format("binaryFile").load(folder)
    return files.select("content").mapInArrow(run, "page_id long, record_type string, record_id string, url string, payload_bytes long, payload_digest string, payload binary, refers_to long")


def pages_to_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages through ARC archives and the converter to WARC archives, which are read back.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to`` and the record's id and url. A null html is an empty payload.
    Payloads under 100 bytes are always responses. Of equal payloads the
    smallest id is the response; a null id comes after all others. Rows that
    repeat the id of a response are responses too, for a revisit needs
    another id to refer to. White space in a url is percent-encoded, a null
    or empty url is ``-``. Further columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "archives")
    write_arc(pages, f"{folder}/arc", id_col, url_col, html_col, archive_bytes)
    arc_to_warc(spark, [f"{folder}/arc/v1", f"{folder}/arc/v2"], f"{folder}/warc", archive_bytes)
    return read_warc(spark, f"{folder}/warc").drop("payload")
