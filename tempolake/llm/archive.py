"""Converting legacy ARC archives to WARC, and writing and reading both.

An ARC file starts with a version block that names the fields of the header lines of its
records; the last field is the length of what follows. The converter reads records of either
version by their declared lengths and makes up what a WARC record needs and ARC lacks: an
identifier, a timestamp in ISO form, a record type and digests. Of records with equal payloads
one is a response and the others revisit it.

Archives are written by Spark's text sink, which writes the bytes of a value and a separator:
the blank line between ARC records and the two line ends after a WARC record. Files hold a
fixed number of records; each starts with a version block or an information record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempolake.llm import scratch

#: Records per file, the first being the file's own.
FILE_RECORDS = 1000
#: Hadoop's name of zlib's level 4: files a few percent larger than at its usual 6, in less than
#: half the time.
ZLIB_LEVEL = "FOUR"

# The header fields of the ARC versions and the revisit profile.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length",
    ],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_NAMES = uuid.UUID("6f0e7c1e-5d0b-5a57-9d5c-6a1f4be0a4f1")
#: Parts that the records of one payload are dealt into.
SALTS = 16
_ID_MARK = "#page_id="

RECORD = (
    "page_id long, url string, ip string, date string, content_type string, digest string, "
    "payload_bytes long, block binary"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header of a block; a block without one is all payload."""
    if not block.startswith(b"HTTP/"):
        return block
    head, mark, rest = block.partition(b"\r\n\r\n")
    return rest if mark else b""


# -- streams -------------------------------------------------------------------------------


class Stream:
    """Reads lines and byte counts from an archive's bytes, unpacking gzip members piecewise."""

    def __init__(self, raw: bytes, piece: int = 1 << 18):
        self._raw = memoryview(raw)
        self._at, self._piece = 0, piece
        self._gzip = raw[:2] == b"\x1f\x8b"
        self._unpack = zlib.decompressobj(31) if self._gzip else None
        self._held = bytearray()
        self._from = 0

    def _more(self) -> bool:
        if self._at >= len(self._raw):
            return False
        part = self._raw[self._at : self._at + self._piece]
        self._at += len(part)
        if self._from:
            del self._held[: self._from]
            self._from = 0
        if not self._gzip:
            self._held += part
            return True
        self._held += self._unpack.decompress(part)
        while self._unpack.eof:
            rest = self._unpack.unused_data
            if not rest and self._at >= len(self._raw):
                break
            self._unpack = zlib.decompressobj(31)
            if not rest:
                break
            self._held += self._unpack.decompress(rest)
        return True

    def line(self) -> bytes | None:
        """The next line without its end, None at the end of the archive."""
        looked = 0
        while (end := self._held.find(b"\n", self._from + looked)) < 0:
            looked = len(self._held) - self._from
            if not self._more():
                if looked:
                    raise ValueError("the archive ends within a line")
                return None
        out = bytes(self._held[self._from : end])
        self._from = end + 1
        return out.removesuffix(b"\r")

    def take(self, size: int) -> bytes:
        while len(self._held) - self._from < size:
            if not self._more():
                raise ValueError("the archive ends within a record")
        out = bytes(self._held[self._from : self._from + size])
        self._from += size
        return out


# -- ARC -----------------------------------------------------------------------------------


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The first record of an ARC file, without the line end that separates records."""
    about = f"{version} 0 legacy\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Content-type": "text/plain"}
    return arc_record(version, head | {"Archive-date": date, "Filename": name}, about)


def arc_record(version: int, fields: dict[str, str], block: bytes) -> bytes:
    values = fields | {"Archive-length": str(len(block))}
    line = " ".join(values.get(field, "-") for field in ARC_FIELDS[version])
    return line.encode("utf-8", "surrogatepass") + b"\n" + block


def read_arc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of an ARC file, its version block left out.

    Raises ValueError when a header line or a length doesn't fit: a damaged archive must not
    pass as a shorter one.
    """
    stream = Stream(raw)
    names: list[str] | None = None
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        values = line.decode("utf-8", "surrogateescape").split(" ")
        if values[0].startswith("filedesc:"):
            about = stream.take(int(values[-1])).decode("utf-8", "replace").split("\n")
            version = int(about[0].split(" ")[0])
            named = about[1].split(" ") if len(about) > 1 and about[1] else []
            names = named or ARC_FIELDS[version]
            continue
        if names is None:
            raise ValueError("the archive has no version block")
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"a header line has {len(values)} fields instead of {len(names)}")
        fields = dict(zip(names, values, strict=True))
        yield fields, stream.take(int(values[-1]))


# -- WARC ----------------------------------------------------------------------------------


def iso_date(arc_date: str) -> str:
    """ARC dates have 8 to 14 digits; what is missing is the start of the period."""
    digits = re.sub(r"\D", "", arc_date)[:14]
    digits += "00000101000000"[len(digits) :]
    d = digits
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str) -> str:
    """The same identifier whenever the same record is converted."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{url} {date} {digest}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = ["WARC/1.0", *(f"{n}: {v}" for n, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def read_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of all records of a WARC file; ValueError when it is damaged."""
    stream = Stream(raw)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not start with its version")
        headers: dict[str, str] = {}
        while line := stream.line():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name] = value.strip()
        if "Content-Length" not in headers:
            raise ValueError("a record has no length")
        yield headers, stream.take(int(headers["Content-Length"]))


# -- jobs ----------------------------------------------------------------------------------


def _in_files(
    rows: DataFrame, first: Callable[[int, int], bytes], record: Callable[[dict, int], bytes]
) -> DataFrame:
    """Records as strings, with a file's own record before every FILE_RECORDS - 1 of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for at in range(len(batch)):
                row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                number = written // FILE_RECORDS
                if written % FILE_RECORDS == 0:
                    out.append(first(part, number))
                    written += 1
                out.append(record(row, part + number))
                written += 1
                size += len(out[-1])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return rows.mapInArrow(task, "value binary").select(F.col("value").cast("string"))


def _write(records: DataFrame, path: str, separator: str) -> None:
    (
        records.write.option("lineSep", separator)
        .option("compression", "gzip")
        .option("zlib.compress.level", ZLIB_LEVEL)
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def _read(spark: SparkSession, path: str, schema: str, names: list[str], rows_of) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        wanted = [kinds[field.split()[-1]] for field in schema.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                held: list[tuple] = []
                size = 0
                for row in rows_of(content.as_py()):
                    held.append(row)
                    size += sum(len(x) for x in row if isinstance(x, bytes))
                    if size > 1 << 22 or len(held) >= 1000:
                        columns = zip(*held, strict=True)
                        arrays = [pa.array(c, t) for c, t in zip(columns, wanted, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, names)
                        held, size = [], 0
                if held:
                    columns = zip(*held, strict=True)
                    arrays = [pa.array(c, t) for c, t in zip(columns, wanted, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(task, schema)


def page_uri(url: str | None, page_id: int | None) -> str:
    """A URI without blanks that carries the page's id; a mark in the URL itself is escaped."""
    escaped = quote(url or "about:blank", safe="!#$%&'()*+,/:;=?@[]~", errors="surrogatepass")
    escaped = escaped.replace(_ID_MARK, quote(_ID_MARK, safe="="))
    return escaped if page_id is None else f"{escaped}{_ID_MARK}{page_id}"


def page_of(uri: str) -> int | None:
    _, mark, number = uri.rpartition(_ID_MARK)
    return int(number) if mark else None


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """Writes pages (page_id, url, html) as ARC files, of either version in turn.

    A null page is empty, and a null URL is about:blank.
    """

    def first(part: int, number: int) -> bytes:
        version = (part + number) % 2 + 1
        return arc_version_block(version, f"pages-{part}-{number}.arc", date)

    def record(row: dict, file: int) -> bytes:
        block = _HTTP + (row["html"] or "").encode("utf-8", "surrogatepass")
        fields = {
            "URL": page_uri(row["url"], row["page_id"]), "IP-address": "0.0.0.0",
            "Archive-date": date, "Content-type": "text/html", "Result-code": "200",
        }
        return arc_record(file % 2 + 1, fields, block)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    _write(_in_files(rows, first, record), path, "\n")


def read_arc_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of ARC files as rows of ``RECORD``."""

    def rows_of(raw: bytes) -> Iterator[tuple]:
        for fields, block in read_arc(raw):
            payload = payload_of(block)
            yield (
                page_of(fields["URL"]), fields["URL"], fields["IP-address"],
                fields["Archive-date"], fields["Content-type"], sha1_base32(payload),
                len(payload), block,
            )

    names = [field.split()[0] for field in RECORD.split(", ")]
    return _read(spark, path, RECORD, names, rows_of)


def _all_salts() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))


def to_warc(
    records: DataFrame, path: str, least_bytes: int = 0, date: str = "20240101000000"
) -> None:
    """Writes ``RECORD`` rows as WARC files, converted at ``date``, equal payloads once.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest
    page_id is the response, the others revisit it; smaller ones are all responses. Records
    without page_id revisit one that has it, and are responses if none has.
    """
    many = (
        records.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(
            F.count("*").alias("copies"),
            F.max(F.struct("page_id", "url", "date")).alias("kept"),
        )
        .filter("copies > 1")
        .select("digest", "kept", _all_salts().alias("salt"))
    )
    # Many pages may share a payload, such as the empty one: its few facts go to all salts.
    salted = records.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    joined = salted.join(many, ["digest", "salt"], "left").select(
        *[f.split()[0] for f in RECORD.split(", ")],
        F.col("kept.page_id").alias("kept_id"),
        F.col("kept.url").alias("kept_url"),
        F.col("kept.date").alias("kept_date"),
    )

    def first(part: int, number: int) -> bytes:
        name = f"pages-{part}-{number}.warc.gz"
        about = b"software: arc to warc conversion\r\nformat: WARC File Format 1.0\r\n"
        return warc_record(
            [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", record_id(name, "", sha1_base32(about))),
                ("WARC-Date", iso_date(date)),
                ("WARC-Filename", name),
                ("Content-Type", "application/warc-fields"),
            ],
            about,
        )

    def record(row: dict, file: int) -> bytes:
        block, revisit = row["block"], False
        if row["kept_id"] is not None and row["kept_id"] != row["page_id"]:
            revisit = True
            block = block[: len(block) - row["payload_bytes"]]
        http = "application/http; msgtype=response" if block[:5] == b"HTTP/" else row["content_type"]
        headers = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(row["url"], row["date"], row["digest"])),
            ("WARC-Date", iso_date(row["date"])),
            ("WARC-Target-URI", row["url"]),
            ("WARC-IP-Address", row["ip"]),
            ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
            ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
            ("Content-Type", http),
        ]
        if revisit:
            kept = record_id(row["kept_url"], row["kept_date"], row["digest"])
            headers += [
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", kept),
                ("WARC-Refers-To-Target-URI", row["kept_url"]),
                ("WARC-Refers-To-Date", iso_date(row["kept_date"])),
                ("X-Payload-Length", str(row["payload_bytes"])),
            ]
        return warc_record(headers, block)

    _write(_in_files(joined, first, record), path, "\r\n\r\n")


PAGE_RECORD = (
    "page_id long, url string, record_id string, date string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read_warc_records(spark: SparkSession, path: str) -> DataFrame:
    """The page records of WARC files as rows of ``PAGE_RECORD``; digests are checked."""

    def rows_of(raw: bytes) -> Iterator[tuple]:
        for headers, block in read_warc(raw):
            kind = headers["WARC-Type"]
            if kind == "warcinfo":
                continue
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            payload = payload_of(block)
            refers_to = None
            size = len(payload)
            if kind == "revisit":
                refers_to = page_of(headers["WARC-Refers-To-Target-URI"])
                size = int(headers["X-Payload-Length"])
            elif sha1_base32(payload) != digest:
                raise ValueError(f"{headers['WARC-Record-ID']} does not fit its digest")
            uri = headers["WARC-Target-URI"]
            yield (
                page_of(uri), uri, headers["WARC-Record-ID"], headers["WARC-Date"], kind, size,
                digest, refers_to, payload,
            )

    names = [field.split()[0] for field in PAGE_RECORD.split(", ")]
    return _read(spark, path, PAGE_RECORD, names, rows_of)


def convert_pages(pages: DataFrame) -> DataFrame:
    """Pages written as ARC files, converted to WARC files and read back.

    One row of ``PAGE_RECORD`` per row of ``pages``; repeated rows give a record each, all of
    the same type and id. Null pages are empty, null URLs about:blank, and rows without page_id
    come back without it whatever their URL says. Of pages with equal payloads the one with the
    largest page_id is the response; rows that share this page_id and payload are all responses.
    An empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    arc, warc = scratch.folder(spark, "arc"), scratch.folder(spark, "warc")
    write_arc(pages, arc)
    to_warc(read_arc_records(spark, arc), warc)
    return read_warc_records(spark, warc)
