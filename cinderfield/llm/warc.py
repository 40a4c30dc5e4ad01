"""WARC archives as a PySpark data source, and page archives with revisit records (operator 11).

Reading: files are packed into partitions of about PARTITION_BYTES. Record types and
other header columns in a filter are pushed down: a record's headers are parsed
first, and the payload of a record that the filter rejects is neither inflated nor
decoded. Members of compressed files written here carry their length, so such a
record is skipped by one seek; other files are inflated as far as the next member.

Writing: each task writes its files below a staging folder of the job, and the commit
moves those of the tasks that ended well, so a lost executor leaves nothing behind.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from cinderfield.scratch import scratch_path, settle

PARTITION_BYTES = 64 << 20
ROLL_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
BATCH_RECORDS = 1000
LEAST_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
# Names of the format, in the order in which they are written.
HEADERS = {
    "type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "profile": "WARC-Profile",
    "content_type": "Content-Type",
}
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_BLOCK = "application/http; msgtype=response"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
IN_BRACKETS = ("record_id", "refers_to")

SCHEMA = ", ".join(f"{name} string" for name in HEADERS) + ", content_length long, file string, offset long, payload binary"
_ARROW = pa.schema([*((n, pa.string()) for n in HEADERS), ("content_length", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("payload", pa.binary())])


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI; ``file:/a`` as Hadoop writes it counts as ``file:///a``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line: control characters as percent escapes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = [VERSION]
    for name, title in HEADERS.items():
        value = headers.get(name)
        if value is not None:
            value = f"<{_clean(value)}>" if name in IN_BRACKETS else _clean(value)
            lines.append(f"{title}: {value}".encode())
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """One gzip member with an extra field ``sl``: its own length and that of the data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 4 + 8 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class _Files(InputPartition):
    paths: list[str]


@dataclass
class _Written(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.packed = options.get("compression", "gzip") == "gzip"
        self.columns = schema.fieldNames()
        self.staging = f".staging-{uuid.uuid4().hex}"
        if unknown := {*self.columns} - {*HEADERS, "payload"}:
            raise ValueError(f"columns that no record holds: {sorted(unknown)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = filesystem(self.path)
        system.create_dir(f"{root}/{self.staging}", recursive=True)
        context, done, out, size = TaskContext.get(), _Written(), None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                data = record_bytes(row, self.block(row))
                data = gzip_member(data) if self.packed else data
                if out is not None and size + len(data) > ROLL_BYTES:
                    out.close()
                    out = None
                if out is None:
                    ending = ".warc.gz" if self.packed else ".warc"
                    done.names.append(f"part-{context.partitionId():05d}-{len(done.names):03d}-{uuid.uuid4().hex[:12]}{ending}")
                    out, size = system.open_output_stream(f"{root}/{self.staging}/{done.names[-1]}", compression=None), 0
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return done

    def block(self, row: dict) -> bytes:
        payload = row.get("payload") or b""
        return HTTP_HEAD + payload if (row.get("content_type") or "").startswith("application/http") else payload

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = filesystem(self.path)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if info.type == fs.FileType.File:
                    system.delete_file(info.path)
        for message in messages:
            for name in message.names if message else ():
                system.move(f"{root}/{self.staging}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = filesystem(self.path)
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


class _Member:
    """A record's bytes: the rest of a plain file, or one gzip member inflated as it is read."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.start = file, file.tell()
        head = file.peek(2)[:2]
        self.packed = head == b"\x1f\x8b"
        self.ends = None
        if self.packed:
            fixed = file.read(12)
            if fixed[3] & 4:
                extra = file.read(struct.unpack("<H", fixed[10:12])[0])
                while len(extra) >= 4:
                    kind, size = extra[:2], struct.unpack("<H", extra[2:4])[0]
                    if kind == b"sl" and size == 8:
                        self.ends = self.start + struct.unpack("<I", extra[4:8])[0]
                    extra = extra[4 + size :]
            file.seek(self.start)
            self.inflater, self.ready = zlib.decompressobj(31), b""

    def fill(self) -> bool:
        if self.inflater.eof:
            return False
        data = self.file.read(16384)
        if not data:
            raise EOFError("cut off inside a record")
        self.ready += self.inflater.decompress(data)
        return True

    def line(self) -> bytes:
        if not self.packed:
            return self.file.readline(1 << 20)
        while b"\n" not in self.ready and self.fill():
            pass
        found, mark, self.ready = self.ready.partition(b"\n")
        return found + mark

    def read(self, size: int) -> bytes:
        if not self.packed:
            return self.file.read(size)
        parts, missing = [self.ready], size - len(self.ready)
        self.ready = b""
        while missing > 0 and self.fill():
            parts.append(self.ready)
            missing -= len(self.ready)
            self.ready = b""
        whole = b"".join(parts)
        self.ready = whole[size:]
        return whole[:size]

    def close(self, unread: int) -> None:
        """To the next record; ``unread`` bytes of this one's block are left. What was read is checked against its sum."""
        if not self.packed:
            self.file.seek(unread, io.SEEK_CUR)
            self.file.read(4)
        elif self.ends is not None and unread:
            self.file.seek(self.ends)
        else:
            while self.fill():
                self.ready = b""
            self.file.seek(-len(self.inflater.unused_data), io.SEEK_CUR)


def _holds(f: Filter, value: str | None) -> bool:
    match f:
        case EqualTo() | EqualNullSafe():
            return value == f.value
        case In():
            return value in f.value
        case IsNotNull():
            return value is not None
        case IsNull():
            return value is None
        case StringStartsWith():
            return value is not None and value.startswith(f.value)
        case StringEndsWith():
            return value is not None and value.endswith(f.value)
        case StringContains():
            return value is not None and f.value in value
    raise NotImplementedError(str(f))


_PUSHED = (EqualTo, EqualNullSafe, In, IsNotNull, IsNull, StringStartsWith, StringEndsWith, StringContains)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, IsNotNull) and f.attribute == ("file",):
                continue  # holds for every record (see read_archive)
            if isinstance(f, _PUSHED) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[_Files]:
        system, root = filesystem(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root))
        files = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")) and f.base_name.endswith((".warc", ".warc.gz"))]
        packs: list[_Files] = []
        size = PARTITION_BYTES
        for f in sorted(files, key=lambda f: f.path):
            if size + f.size > PARTITION_BYTES:
                packs.append(_Files([]))
                size = 0
            packs[-1].paths.append(f.path)
            size += f.size
        return packs or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as file:
                for row in self.records(path, file):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def records(self, path: str, file: io.BufferedReader) -> Iterator[dict]:
        """The records whose headers pass the pushed filters."""
        while file.peek(1):
            offset, member = file.tell(), _Member(file)
            if not member.line().startswith(b"WARC/"):
                raise ValueError(f"no record at byte {offset} of {path}")
            given = {}
            while line := member.line().strip(b"\r\n"):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                given[name.strip().lower()] = value.strip()
            row = {name: given.get(title.lower()) for name, title in HEADERS.items()}
            for name in IN_BRACKETS:
                if row[name] is not None:
                    row[name] = row[name].removeprefix("<").removesuffix(">")
            length = int(given["content-length"])
            if not all(_holds(f, row[f.attribute[0]]) for f in self.filters):
                member.close(length)
                continue
            payload = None
            if self.payloads:
                payload, length = member.read(length), 0
                if (row["content_type"] or "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            member.close(length)
            yield row | {"content_length": int(given["content-length"]), "file": path, "offset": offset, "payload": payload}


class Warc(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Options: ``path``; ``payload=false`` reads headers only; ``compression`` none or
    gzip (default), one member per record.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach it (Spark's switch for that is off by default)."""
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the .warc and .warc.gz files in a folder, or of one file.

    The path is opened by the executors through pyarrow: file, HDFS and object stores.
    A damaged file fails the job with its name and the byte.

    Spark keeps a reader with the filters last given to it, and reads of the same frame
    without a filter would use it again: the filter here, which every record passes, gives
    each read a reader of its own. One plan that reads an archive with different filters
    needs a frame for each.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path).where(F.col("file").isNotNull())


def write_archive(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write rows of header columns (``HEADERS``) and payload as records, a file per task and 64 MB."""
    register(records.sparkSession)
    records.write.format("warc").option("compression", compression).mode("append").save(path)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", name: str = "urn:page:") -> DataFrame:
    """Rows to write for pages: a response, or a revisit of the page of smallest id with the same payload.

    Payloads of under 100 bytes are always responses. Rows that repeat the smallest
    id are responses each. A null html is an empty payload, a null url gives no
    header; a row without id gives a record without, which revisits a page with the
    same payload and an id if there is one. Payloads are compared by SHA-256; the
    list of repeated ones has no broadcast hint.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long = F.octet_length("payload") >= LEAST_REVISIT
    equal = rows.where(long).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    rows = rows.join(settle(equal.where(F.col("first").isNotNull()).select("digest", "first"), "payloads"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def named(page: Column) -> Column:
        return F.concat(F.lit(name), page.cast("string"))

    return rows.select(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("type"),
        named(F.col("id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.when(again, named(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, F.lit(REVISIT_PROFILE)).alias("profile"),
        F.lit(HTTP_BLOCK).alias("content_type"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_facts(spark: SparkSession, path: str, name: str = "urn:page:") -> DataFrame:
    """Rows (page_id string, payload_bytes, payload_digest, record_type, refers_to string) of an archive of pages.

    Responses are measured by their payload; revisits take the size of the response
    they refer to, which must hold the digest they name.
    """
    def page(column: str) -> Column:
        return F.substring(F.col(column), len(name) + 1, 1 << 30)

    archive = read_archive(spark, path)
    responses = archive.where(F.col("type") == "response").select(
        page("record_id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    responses = settle(responses, "responses")
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    headers = read_archive(spark, path, payload=False).where(F.col("type") == "revisit")
    revisits = headers.select(
        page("record_id").alias("page_id"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        F.lit("revisit").alias("record_type"),
        page("refers_to").alias("refers_to"),
    ).join(sizes, ["refers_to", "payload_digest"], "left")
    plain = responses.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to"))
    return plain.unionByName(revisits)
