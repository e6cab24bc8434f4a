"""WARC records in ZIP packages: written by Spark tasks, read back by ranges without extraction.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` (one gzip member per WARC record)
and ``indexes/index.cdxj`` (a line per record with its offset and length inside the archive member). A reader needs the
ZIP directory (ZIP64 included), the index, and then one range per record.

Packages go to the folder given, through any file system that pyarrow opens. A task writes under names of its own and
reports them; only reported packages are read, so a lost or repeated task attempt leaves nothing behind in the results.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import settle, shared_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20
REVISIT_FROM = 1000
DATE = "1970-01-01T00:00:00Z"
#: Fixed value: the profile that the WARC standard gives to revisits with an identical payload.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "payload binary")


# ---- records ----

def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 response, or a revisit: its HTTP header without the payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode().split("\r\n")[1:])}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(raw: bytes) -> tuple:
    """The fields of ``RECORDS``. A response's size and digest are taken from its payload, a revisit's from its headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    url, page = warc.get("warc-target-uri"), _page(warc["warc-record-id"])
    if warc["warc-type"] == "revisit":
        return (page, url, int(_headers(http)["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:"),
                "revisit", _page(warc["warc-refers-to"]), None)
    digest = hashlib.sha1(payload).hexdigest()
    if warc["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError(f"payload of record {warc['warc-record-id']} does not have its digest")
    return page, url, len(payload), digest, "response", None, payload


# ---- ZIP packages ----

def members(file) -> dict[str, tuple[int, int]]:
    """Name to (start, size) of every stored member, from the central directory; ZIP64 fields are followed."""
    size = file.size()
    tail_at = max(0, size - 65_557)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    count, length, at = struct.unpack_from("<HLL", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, at):
        place, = struct.unpack_from("<Q", tail, end - 20 + 8)
        count, length, at = struct.unpack_from("<QQQ", file.read_at(56, place), 32)
    directory, found, p = file.read_at(length, at), {}, 0
    for _ in range(count):
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<LLHHH", directory, p + 20)
        start, = struct.unpack_from("<L", directory, p + 42)
        name = directory[p + 46:p + 46 + n_name].decode()
        wide, q, stop = [], p + 46 + n_name, p + 46 + n_name + n_extra
        while q + 4 <= stop:
            kind, n = struct.unpack_from("<HH", directory, q)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{n // 8}Q", directory, q + 4))
            q += 4 + n
        plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
        packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
        start = wide.pop(0) if start == 0xFFFFFFFF else start
        if method == 0 and not flags & 1:
            local = struct.unpack_from("<HH", file.read_at(4, start + 26))
            found[name] = (start + 30 + sum(local), packed)
        p = stop + n_note
    return found


class _Package:
    """A package being written: records go straight to the archive member, index lines are kept until it is closed."""

    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        system, path = fs.FileSystem.from_uri(self.path)
        self.sink = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines, self.at = [], 0

    def add(self, page_id, url, payload: bytes, refers_to) -> None:
        raw = gzip.compress(record(page_id, url, payload, refers_to), 3, mtime=0)
        self.member.write(raw)
        entry = {"url": url, "page": page_id, "offset": self.at, "length": len(raw), "filename": ARCHIVE.split("/")[1]}
        self.lines.append(f"{page_id} {DATE} {json.dumps(entry)}")
        self.at += len(raw)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.sink.close()
        return self.path, len(self.lines)


def open_package(path: str):
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def index(file) -> list[dict]:
    start, size = members(file)[INDEX]
    return [json.loads(line.split(" ", 2)[2]) for line in file.read_at(size, start).decode().split("\n") if line]


def read_range(file, entry: dict) -> tuple:
    """One record, read by its range inside the stored archive member."""
    start, _ = members(file)[f"archive/{entry['filename']}"]
    return parse_record(gzip.decompress(file.read_at(entry["length"], start + entry["offset"])))


# ---- Spark ----

def with_revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of ``least`` bytes or more, all but the largest page_id refer to it.

    Payloads are equal when their SHA-1 and SHA-256 are. Only narrow rows are grouped (with partial aggregation), and the
    answer is joined by page, so a payload shared by a third of all pages loads no task more than others.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), html.alias("html"))
    keyed = rows.filter(F.octet_length("html") >= least).select(
        "page_id", F.unhex(F.sha2("html", 256)).alias("key"), F.unhex(F.sha1("html")).alias("digest"))
    groups = settle(keyed.groupBy("key", "digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
                    .filter("n > 1").drop("n"))
    refer = (keyed.join(groups, ["key", "digest"]).filter("page_id < first")
             .select(F.col("page_id").alias("_page"), F.col("key").alias("_key"), F.col("first").alias("refers_to")).distinct())
    long = F.when(F.octet_length("html") >= least, F.unhex(F.sha2("html", 256)))
    return (rows.join(refer.hint("merge"), (F.col("page_id") == F.col("_page")) & (long == F.col("_key")), "left")
            .select("page_id", "url", "html", "refers_to"))


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` rows as packages; returns ``package, records`` of those that count."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64).to_pydict()
                for row in zip(part["page_id"], part["url"], part["html"], part["refers_to"], strict=True):
                    package = package or _Package(folder)
                    package.add(row[0], row[1], row[2].encode(), row[3])
                    if package.at > PACKAGE_BYTES:
                        done.append(package.close())
                        package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_pydict({"package": [p for p, _ in done], "records": [n for _, n in done]})

    return settle(pages.mapInArrow(write, "package string, records long"))


def read_packages(packages: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the packages named in column ``package``, each read by its range; see ``RECORDS``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_package(path) as file:
                    places, entries = members(file), index(file)
                    for at in range(0, len(entries), 64):
                        rows = []
                        for e in entries[at:at + 64]:
                            start = places[f"archive/{e['filename']}"][0] + e["offset"]
                            row = parse_record(gzip.decompress(file.read_at(e["length"], start)))
                            rows.append(row if payload else (*row[:-1], None))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    spark = packages.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return packages.select("package").repartition(parts).mapInArrow(read, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, least: int = REVISIT_FROM, payload: bool = True) -> DataFrame:
    """Write every page as a WARC record and read the packages back.

    Null html is an empty payload; a null url has no target header; control characters in a url are percent-encoded; a
    null page_id stays null and refers to nothing. A page given twice is written twice, with the same type. Other columns are
    not read; an empty table gives no packages and no rows.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/packages-{uuid.uuid4().hex}"
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return read_packages(write_packages(with_revisits(pages, least), folder), payload)


ORACLE = """
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     s AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
                  max(page_id) OVER (PARTITION BY body) AS latest FROM t)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
FROM s
"""
