"""WARC archives as a PySpark data source, and payload dedup with revisit records.

``spark.read.format("warc")`` plans one partition per stretch of a file. Every
record is a gzip member of its own that carries its compressed length in an
extra header field, so the reader inflates the WARC header, decides by record
type and header filters pushed down to it, and jumps over the rest of a record
that nobody wants. Members without that field are inflated through: they are
read by the stretch that holds the last member with the field before them, or
the file's first one, so a file of another writer is read by one task.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from cargolens.session import scratch_path, staged

#: Header lines of a record by column; fixed by the WARC format.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
}
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes long, payload binary"

#: gzip flag for extra fields, and the name of the field that holds the member's length.
EXTRA, LENGTH_FIELD = 4, b"sl"
MAGIC = b"\x1f\x8b\x08"
MEMBER = MAGIC + bytes([EXTRA, 0, 0, 0, 0, 0, 255]) + struct.pack("<H2sH", 12, LENGTH_FIELD, 8)

#: Bytes read at a time while looking at headers, and of a file per partition.
HEAD_BYTES, SPLIT_BYTES = 2048, 64 << 20


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def line(value: str) -> str:
    """A value on one header line."""
    return value.replace("\r", "%0D").replace("\n", "%0A").strip()


def member(raw: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field says how long it and its content are."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    sizes = struct.pack("<II", len(MEMBER) + 8 + len(body) + len(tail), len(raw) & 0xFFFFFFFF)
    return b"".join((MEMBER, sizes, body, tail))


def record(row: dict, payload: bytes, payload_bytes: int) -> bytes:
    """One WARC record; a revisit keeps the HTTP header of the payload it refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    head = ["WARC/1.1"]
    for column, name in HEADERS.items():
        value = row.get(column)
        if column == "payload_digest" and value is not None:
            value = f"sha1:{value}"
        if column == "content_type":
            value = f"application/http; msgtype={'response' if revisit else row['record_type']}"
        if column in ("record_id", "refers_to") and value is not None:
            value = f"<{line(value)}>"
        if value is not None:
            head.append(f"{name}: {line(value)}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_of(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    out = {}
    for text in lines[1:]:
        name, _, value = text.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class Members:
    """Records of one stretch of a gzip file, header first.

    A stretch goes on behind its end up to the first member that ``_first`` of
    a later stretch can find; no other one reads what lies before that.
    """

    def __init__(self, file, start: int, end: int, size: int):
        self.file, self.end, self.size = file, min(end, size), size
        self.at = self._first(start) if start else 0

    def _first(self, start: int) -> int:
        """Start of the first member at or after ``start``: the signature, followed by a WARC record."""
        at, carry = start, b""
        while at - len(carry) < self.end:
            self.file.seek(at)
            block = self.file.read(1 << 20)
            if not block:
                return self.size
            seen, base, hit = carry + block, at - len(carry), -1
            while (hit := seen.find(MEMBER, hit + 1)) >= 0:
                if base + hit >= self.end:
                    return self.size
                if self._is_record(base + hit):
                    return base + hit
            carry, at = seen[-(len(MEMBER) - 1) :], at + len(block)
        return self.size

    def _is_record(self, at: int) -> bool:
        self.file.seek(at)
        try:
            return zlib.decompressobj(31).decompress(self.file.read(HEAD_BYTES), 8).startswith(b"WARC/")
        except zlib.error:
            return False

    def _ends(self) -> bool:
        """True where the file ends, or a later stretch begins to read."""
        if self.at < self.end or self.at >= self.size:
            return self.at >= self.size
        self.file.seek(self.at)
        return self.file.read(len(MEMBER)) == MEMBER and self._is_record(self.at)

    def __iter__(self) -> Iterator[tuple[dict[str, str], Members]]:
        while not self._ends():
            self.file.seek(self.at)
            self.read = self.file.read(HEAD_BYTES)
            if not self.read.startswith(MAGIC):
                raise ValueError(f"no gzip member at byte {self.at}")
            known = self.read.startswith(MEMBER)
            self.length = struct.unpack_from("<I", self.read, len(MEMBER))[0] if known else None
            self.inflate, self.raw, self.fed = zlib.decompressobj(31), b"", 0
            while (gap := self.raw.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    raise ValueError(f"a record at byte {self.at} has no end of header")
            self.gap = gap + 4
            yield header_of(self.raw[:gap]), self
            if self.length is None:
                while self._more():
                    self.raw = b""  # nobody wants it
                self.length = self.fed - len(self.inflate.unused_data)
            self.at += self.length

    def _more(self) -> bool:
        """Inflate the next bytes read; False at the member's end."""
        if self.inflate.eof:
            return False
        if self.fed:
            self.read = self.file.read(1 << 16)
        if not self.read:
            raise ValueError(f"the record at byte {self.at} is cut off")
        self.fed += len(self.read)
        self.raw += self.inflate.decompress(self.read)
        return True

    def block(self, length: int, stop_at_http: bool = False) -> bytes:
        """The record's block, or as much of it as holds the HTTP header."""
        pieces = io.BytesIO()
        pieces.write(self.raw[self.gap :])
        self.raw = b""
        while pieces.tell() < length and not (stop_at_http and b"\r\n\r\n" in pieces.getvalue()):
            if not self._more():
                raise ValueError(f"the record at byte {self.at} is shorter than its length")
            pieces.write(self.raw)
            self.raw = b""
        return pieces.getvalue()[:length]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class Stretch(InputPartition):
    file: str
    start: int
    end: int
    size: int

    def __post_init__(self):
        super().__init__((self.file, self.start))


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class WarcSource(DataSource):
    """``payload`` option: ``keep`` (default), ``verify`` (digest checked, payload not returned) or ``skip``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "keep")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        if self.payload not in ("keep", "verify", "skip"):
            raise ValueError(f"payload is keep, verify or skip, not {self.payload}")
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.wanted.append((column, "in", {f.value}))
            elif column in HEADERS and isinstance(f, In):
                self.wanted.append((column, "in", set(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", f.value))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.wanted.append((column, "present", None))
            else:
                yield f

    def partitions(self) -> list[Stretch]:
        where, root = opened(self.path)
        listed = where.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((f for f in listed if f.is_file and f.path.endswith(".warc.gz") and "/_" not in f.path[len(root) :]), key=lambda f: f.path)
        cuts = [Stretch(f.path, a, min(a + self.split, f.size), f.size) for f in files for a in range(0, f.size, self.split)]
        return cuts or [Stretch("", 0, 0, 0)]

    def fits(self, values: dict[str, str | None]) -> bool:
        for column, how, what in self.wanted:
            v = values[column]
            if v is None or how == "in" and v not in what or how == "starts" and not v.startswith(what):
                return False
        return True

    def read(self, part: Stretch) -> Iterator[tuple]:
        if not part.file:
            return
        where, _ = opened(self.path)
        with where.open_input_file(part.file) as file:
            for header, rest in Members(file, part.start, part.end, part.size):
                values = {c: header.get(name.lower()) for c, name in HEADERS.items()}
                for c in ("record_id", "refers_to"):
                    if values[c] is not None:
                        values[c] = values[c].removeprefix("<").removesuffix(">")
                if values["payload_digest"] is not None:
                    values["payload_digest"] = values["payload_digest"].rpartition(":")[2]
                if not self.fits(values):
                    continue
                whole = self.payload != "skip" and values["record_type"] != "revisit"
                block = rest.block(int(header["content-length"]), stop_at_http=not whole)
                payload, size = self.http(block, header) if whole else (None, self.http(block, header)[1])
                if whole and values["payload_digest"] not in (None, digest_of(payload)):
                    raise ValueError(f"payload of {values['record_id']} differs from its digest")
                yield (*values.values(), size, payload if self.payload == "keep" else None)

    @staticmethod
    def http(block: bytes, header: dict) -> tuple[bytes, int]:
        """Payload of a block, and its length by the HTTP header if there is one."""
        if "application/http" not in header.get("content-type", ""):
            return block, int(header["content-length"])
        head, _, payload = block.partition(b"\r\n\r\n")
        for text in head.split(b"\r\n")[1:]:
            name, _, value = text.partition(b":")
            if name.strip().lower() == b"content-length":
                return payload, int(value)
        return payload, len(payload)


class WarcWriter(DataSourceArrowWriter):
    """One file per task, written aside and moved in place when all tasks have ended well."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 4))
        self.run = uuid.uuid4().hex
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = opened(self.path)
        aside, name, out = f"{root}/_{self.run}", f"{uuid.uuid4().hex}.warc.gz", None
        try:
            for batch in iterator:
                payloads = batch.column("payload")
                rest = batch.drop_columns(["payload"]).to_pylist()
                for i, row in enumerate(rest):
                    if out is None:
                        where.create_dir(aside)
                        out = where.open_output_stream(f"{aside}/{name}", compression=None)
                    payload = payloads[i].as_buffer()
                    payload = payload.to_pybytes() if payload is not None else b""
                    size = row.get("payload_bytes")
                    out.write(member(record(row, payload, len(payload) if size is None else size), self.level))
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None)

    def commit(self, messages: list[Written]) -> None:
        where, root = opened(self.path)
        if self.overwrite and where.get_file_info(root).type == pafs.FileType.Directory:
            for f in where.get_file_info(pafs.FileSelector(root)):
                if f.path.endswith(".warc.gz"):
                    where.delete_file(f.path)
        where.create_dir(root)
        for m in messages:
            if m and m.file:
                where.move(f"{root}/_{self.run}/{m.file}", f"{root}/{m.file}")
        self.abort([])

    def abort(self, messages: list[Written]) -> None:
        where, root = opened(self.path)
        if where.get_file_info(f"{root}/_{self.run}").type == pafs.FileType.Directory:
            where.delete_dir(f"{root}/_{self.run}")


def register(spark) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, digest, refers_to``: the page that has the payload, for revisits.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the
    largest ``page_id`` keeps it. Rows that repeat this id keep it, too; pages
    without an id keep theirs if no page with an id has the same. Null html is
    empty. Only narrow rows meet by payload; the html is dealt by page once.
    """
    raw = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    raw = raw.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    narrow = raw.filter(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_bytes", "digest")
    same = narrow.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    same = staged(same.filter("n > 1 and keeper is not null").drop("n"), "payloads")
    revisits = narrow.join(same, ["digest", "payload_bytes"]).filter("page_id is null or page_id < keeper")
    revisits = revisits.select(F.col("page_id").alias("id"), F.col("digest").alias("sum"), "keeper").distinct()
    met = (F.col("page_id").eqNullSafe(F.col("id"))) & (F.col("digest") == F.col("sum"))
    return raw.join(revisits, met, "left").drop("id", "sum").withColumnRenamed("keeper", "refers_to")


def urn(page_id) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(record_id) -> Column:
    return F.expr(f"try_cast(substr({record_id}, 10) as bigint)")


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 4) -> None:
    """Write a record per page: a response, or a revisit of the page that keeps its payload.

    ``pages`` has ``page_id, url, html``; others are not written. An empty
    table writes no file. ``date`` is the records' date, since pages have none.
    """
    spark = pages.sparkSession
    register(spark)
    flagged = with_revisits(pages, least_bytes)
    digest = F.call_function("unhex", F.col("digest"))
    rows = flagged.select(
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.lit(date).alias("date"),
        F.col("url").alias("target_uri"),
        F.when(F.col("refers_to").isNotNull(), urn(F.col("refers_to"))).alias("refers_to"),
        digest.alias("digest"),
        "payload_bytes",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
    )
    rows = rows.withColumn("payload_digest", base32("digest")).drop("digest")
    rows.write.format("warc").mode("append").option("level", level).save(path)


def base32(column: str) -> Column:
    """Base32 of the 20 bytes of a SHA-1, eight characters to five bytes."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = F.hex(column)
    parts = []
    for at in range(0, 40, 10):
        five = F.conv(F.substring(digits, at + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            place = F.shiftright(five, shift).bitwiseAND(F.lit(31)) + 1
            parts.append(F.substring(letters, place.cast("int"), F.lit(1)))
    return F.concat(*parts)


def read_records(spark, path: str, payload: str = "keep") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back, payloads verified."""
    path = scratch_path(pages.sparkSession, "warc")
    write_pages(pages, path, least_bytes)
    return read_records(pages.sparkSession, path, "verify")
