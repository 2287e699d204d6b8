"""WARC archives as a Spark data source, and pages written to them with revisit records.

Each record is a gzip member of its own whose header carries the member's length (the extra
field "sl"), so a reader can go on to the next record without inflating this one. Writing
leaves files and one manifest per job that names them; files of failed or repeated tasks are
in no manifest, so nobody reads them. The manifest also has record boundaries at which a
large file is split for reading.

    spark.dataSource.register(WarcDataSource)
    spark.read.format("warc").load(path).where("record_type = 'response'")

Reading takes any .warc or .warc.gz files: without manifest, every such file is one partition.
Predicates on record_type, record_id, target_uri, refers_to and payload_digest are decided on
the headers of a record; the option payloads=false leaves all payloads undecoded. A payload
that does not have the length or digest its headers state fails the read."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from footfall.llm.common import staged
from footfall.session import scratch_dir

#: Columns read; those written are record_id, record_type, target_uri, date, refers_to, payload.
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string,"
    " payload_digest string, payload_bytes long, payload binary"
)
_HEADER_COLUMNS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A file is closed at this size; a partition reads about as much as SPLIT_BYTES.
FILE_BYTES, SPLIT_BYTES = 256 << 20, 16 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(record: dict) -> bytes:
    """A response or revisit record, not compressed. A revisit has the HTTP header alone."""
    payload = record["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record["record_type"] == "revisit" else http + payload
    fields = [
        ("WARC-Type", record["record_type"]),
        ("WARC-Record-ID", record["record_id"]),
        ("WARC-Date", record["date"]),
        ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Refers-To", record["refers_to"]),
        ("WARC-Profile", PROFILE if record["record_type"] == "revisit" else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    header = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + header.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field "sl" has its own and the data's length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[tuple[str, list[int]]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 1))
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        files: list[tuple[str, list[int]]] = []
        out, at = None, 0
        for batch in iterator:
            for record in batch.to_pylist():
                if out is None or at >= self.file_bytes:
                    if out:
                        out.close()
                    files.append((f"{uuid.uuid4().hex}.warc.gz", [0]))
                    out, at = fs.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                if at - files[-1][1][-1] >= self.split_bytes:
                    files[-1][1].append(at)
                member = gzip_member(record_bytes(record), self.level)
                out.write(member)
                at += len(member)
        if out:
            out.close()
            files[-1][1].append(at)
        return WrittenFiles(files)

    def commit(self, messages) -> None:
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        lines = [json.dumps(f) for m in messages if m for f in m.files]
        with fs.open_output_stream(f"{root}/manifest-{uuid.uuid4().hex}.jsonl", compression=None) as out:
            out.write("".join(x + "\n" for x in lines).encode())

    def abort(self, messages) -> None:
        fs, root = _file_system(self.path)
        for name in [f for m in messages if m for f, _ in m.files]:
            fs.delete_file(f"{root}/{name}")


@dataclass
class FileRange(InputPartition):
    file: str
    start: int
    end: int | None


class _Buffered:
    """Bytes of a file from a position on, fetched a block at a time."""

    def __init__(self, source, at: int):
        self.source, self.at, self.data = source, at, b""
        source.seek(at)

    def fill(self, size: int) -> bytes:
        """At least ``size`` bytes from here, fewer at the end of the file."""
        while len(self.data) < size:
            more = self.source.read(max(READ_BYTES, size - len(self.data)))
            if not more:
                break
            self.data += more
        return self.data

    def skip(self, size: int) -> None:
        if size <= len(self.data):
            self.data = self.data[size:]
        else:
            self.source.seek(self.at + size)
            self.data = b""
        self.at += size


def _member_length(data: bytes) -> int | None:
    """The length that the extra field "sl" of a gzip header states."""
    if len(data) >= 24 and data[3] & 4 and data[12:14] == b"sl":
        return struct.unpack_from("<I", data, 16)[0]
    return None


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


class _GzipRecord:
    """The record that starts here, inflated only as far as asked for."""

    def __init__(self, source: _Buffered):
        self.source = source
        self.inflater = zlib.decompressobj(31)
        self.plain, self.used = b"", 0

    def upto(self, size: int) -> bytes:
        while len(self.plain) < size and not self.inflater.eof:
            if self.inflater.unconsumed_tail:
                chunk = self.inflater.unconsumed_tail
            else:
                chunk = self.source.fill(self.used + 1)[self.used :]
                if not chunk:
                    raise ValueError("a WARC record breaks off")
                self.used += len(chunk)
            self.plain += self.inflater.decompress(chunk, size - len(self.plain))
        return self.plain

    def head(self, after: int = 0) -> int:
        """The position behind the empty line that ends the header from ``after`` on."""
        size = after + 1024
        while (end := self.upto(size).find(b"\r\n\r\n", after)) < 0:
            if self.inflater.eof:
                raise ValueError("a WARC record has no end of its header")
            size *= 2
        return end + 4

    def finish(self) -> None:
        length = _member_length(self.source.fill(24)[:24])
        if length is None:
            while not self.inflater.eof:
                self.upto(len(self.plain) + READ_BYTES)
            length = self.used - len(self.inflater.unused_data)
        self.source.skip(length)


class _PlainRecord:
    """The same for a file that is not compressed."""

    def __init__(self, source: _Buffered):
        self.source = source

    def upto(self, size: int) -> bytes:
        return self.source.fill(size)[:size]

    def head(self, after: int = 0) -> int:
        size = after + 1024
        while (end := self.upto(size).find(b"\r\n\r\n", after)) < 0:
            if len(self.source.data) < size:
                raise ValueError("a WARC record has no end of its header")
            size *= 2
        return end + 4

    def finish(self) -> None:
        end = self.head()
        length = int(_fields(self.upto(end)).get("content-length", 0))
        self.source.skip(end + length + 4)


def records(source: _Buffered, end: int | None, wanted, payloads: bool) -> Iterator[dict]:
    """Records that start before ``end`` and whose header fields satisfy ``wanted``."""
    while (end is None or source.at < end) and source.fill(1):
        record = (_GzipRecord if source.fill(2)[:2] == b"\x1f\x8b" else _PlainRecord)(source)
        body = record.head()
        fields = _fields(record.upto(body)[:body])
        digest = fields.get("warc-payload-digest", "")
        fields["warc-payload-digest"] = digest.split(":", 1)[-1] if digest else None
        if wanted(fields):
            yield _decoded(record, fields, body, payloads)
        record.finish()


def _decoded(record, fields: dict, body: int, payloads: bool) -> dict:
    kind, block = fields.get("warc-type"), int(fields.get("content-length", 0))
    start, stated = body, None
    if fields.get("content-type", "").startswith("application/http") and block:
        start = record.head(body)
        stated = _fields(record.upto(start)[body:start]).get("content-length")
    size = int(stated) if stated is not None else body + block - start
    payload, digest = None, fields["warc-payload-digest"]
    if payloads and kind != "revisit":
        payload = record.upto(body + block)[start : body + block]
        found = digest_of(payload)
        if len(payload) != size or digest and digest != found and len(digest) == len(found):
            raise ValueError(f"the payload of {fields.get('warc-record-id')} is not what its header states")
        digest = found
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload,
    }


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payloads = str(options.get("payloads", "true")).lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            field = _HEADER_COLUMNS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if field and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.tests.append((field, "in", {f.value}))
            elif field and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.tests.append((field, "in", set(f.value)))
            elif field and isinstance(f, StringStartsWith):
                self.tests.append((field, "starts", f.value))
            elif field and isinstance(f, IsNotNull):
                self.tests.append((field, "starts", ""))
            else:
                yield f

    def partitions(self):
        fs, root = _file_system(self.path)
        listed = fs.get_file_info(pafs.FileSelector(root))
        found: list[FileRange] = []
        manifests = [x for x in listed if x.base_name.startswith("manifest-")]
        for manifest in manifests:
            with fs.open_input_stream(manifest.path) as lines:
                for line in lines.read().decode().splitlines():
                    name, cuts = json.loads(line)
                    found += [FileRange(f"{self.path}/{name}", a, b) for a, b in zip(cuts, cuts[1:])]
        if not manifests:
            files = [x for x in listed if x.is_file and x.base_name.endswith((".warc", ".warc.gz"))]
            found = [FileRange(f"{self.path}/{x.base_name}", 0, None) for x in files]
        return found or [FileRange("", 0, 0)]

    def _wanted(self, fields: dict) -> bool:
        for field, kind, value in self.tests:
            have = fields.get(field)
            if have is None or (have not in value if kind == "in" else not have.startswith(value)):
                return False
        return True

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, path = _file_system(partition.file)
        with fs.open_input_file(path) as source:
            rows, size = [], 0
            for row in records(_Buffered(source, partition.start), partition.end, self._wanted, self.payloads):
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; write to another folder")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, html), as write_archives takes them.

    Of equal payloads the one of the largest page_id is a response and the others revisit it;
    rows that share this page_id are all responses. A null html is an empty payload. A null
    page_id is smaller than any other, and its record's id ends in a colon."""
    rows = pages.select(
        "page_id",
        F.col("url").alias("target_uri"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = rows.groupBy("key").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n"))
    # Written, so that the join is between two plain scans, whose large keys Spark can split.
    groups = staged(groups.where("n > 1 and last_id is not null").drop("n"), "payloads")
    joined = rows.join(groups, "key", "left")
    revisits = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))

    def urn(column: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    return joined.select(
        urn("page_id").alias("record_id"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.when(revisits, urn("last_id")).alias("refers_to"),
        "payload",
    )


def page_of(record_id: str):
    """The page_id in a record's id, null if there is none."""
    found = F.regexp_extract(F.col(record_id), "^<urn:page:(.+)>$", 1)
    return F.when(found != "", found).cast("long")


def write_archives(records: DataFrame, path: str, **options) -> None:
    register(records.sparkSession)
    wanted = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload"]
    records.select(*wanted).write.format("warc").mode("append").options(**options).save(path)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the scratch folder and reads them back: responses with
    their payloads, revisits by their headers alone."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/archives"
    write_archives(page_records(pages), path)
    responses = read_archives(spark, path).where("record_type = 'response'")
    return responses.unionByName(read_archives(spark, path, payloads="false").where("record_type = 'revisit'"))
