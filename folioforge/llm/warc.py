"""WARC archives as a PySpark Python data source.

Reader (``spark.read.format("warc").load(folder)``): plans partitions from the
committed files, takes over equality and IN filters on the record type and on
the promoted header columns, and parses a record's headers first.  A record is
a gzip member whose extra field ``sl`` holds its compressed and its plain
length, so the payload of a record that the filters reject, or whose payload is
not asked for (option ``payload``: ``true``, ``false`` or the record types that
want theirs), is passed over on disk and never inflated.  Members of other
tools, without that field, are inflated in pieces and dropped.

Writer (``df.write.format("warc").mode("append").save(folder)``): each task
writes one gzip file, one member a record, under a name of its own; the commit
writes a manifest of the files of successful attempts, and readers see
manifests only, so a lost executor or a repeated task adds nothing.  An
overwrite commits its manifest before it deletes anything.

Payloads are binary.  Files are reached through ``pyarrow.fs``; the folder must
be on a file system that it knows (local or shared disk, HDFS, S3, GCS).
``write_pages`` and ``read_pages`` resolve a path without a scheme as Spark does.

Defined cases: a null payload is an empty payload; a null URI, date or header
is left out; rows repeated whole are records of their own, and of equal ids
with one payload each is a response; ties go to the smallest id; a null id is
an empty one, and its page is a response; a very long payload is one record,
held whole in memory when it is written and when it is asked for; empty tables
give an archive without records; other columns are not read.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage

from .common import qualified, scratch

LEAST_SHARED = 100
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Column name and the WARC header that it stands for.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "warc_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "WARC-Payload-Length",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"


def _fs(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


# -- records -----------------------------------------------------------------
def record(row: dict) -> bytes:
    """One record: header block, payload, two line ends."""
    payload = bytes(row.get("payload") or b"")
    lines = [f"{name}: {row[column]}".replace("\r", " ").replace("\n", " ") for column, name in HEADERS.items() if row.get(column) is not None]
    if row.get("warc_type") == "revisit":
        lines.append(f"WARC-Profile: {_PROFILE}")
    lines.append(f"Content-Length: {len(payload)}")
    return _VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


_COLUMN_OF = {name.lower(): column for column, name in HEADERS.items()}


def parse_head(lines: Iterator[bytes]) -> tuple[dict, int] | None:
    """(header fields, Content-Length) of the next record; None at the end."""
    for line in lines:
        if line not in (b"\r\n", b"\n"):
            break
    else:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    head, length = {}, 0
    for line in lines:
        if line in (b"\r\n", b"\n"):
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "content-length":
            length = int(value)
        if name in _COLUMN_OF:
            head[_COLUMN_OF[name]] = value
    return head, length


def parse_records(stream: io.BufferedIOBase, wanted, payload) -> Iterator[dict]:
    """Header fields of the wanted records, with ``payload`` bytes where ``payload(head)`` says so.

    For plain streams: what is not asked for is read in pieces and dropped.
    """
    while (found := parse_head(iter(stream.readline, b""))) is not None:
        head, length = found
        if wanted(head) and payload(head):
            head["payload"] = stream.read(length)
            if len(head["payload"]) < length:
                raise ValueError("a record ends before its Content-Length")
            yield head
        else:
            left = length
            while left > 0 and (piece := stream.read(min(left, 1 << 20))):
                left -= len(piece)
            if wanted(head):
                yield head


# -- gzip members ------------------------------------------------------------
#: Fixed values of the gzip format: magic number, deflate, extra field; the field's name and its size.
_MAGIC, _FIELD, _START = b"\x1f\x8b\x08\x04", b"sl\x08\x00", 24


def packed(data: bytes) -> bytes:
    """A gzip member that tells its own compressed and plain length in the extra field ``sl``."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    whole = _START + len(body) + 8
    extra = _FIELD + struct.pack("<II", whole if whole < 1 << 32 else 0, len(data) & 0xFFFFFFFF)  # 0: not told
    return _MAGIC + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Inflated:
    """The plain bytes of a member's body, inflated only as far as they are asked for."""

    def __init__(self, file, size: int):
        self.file, self.left, self.engine, self.held = file, size, zlib.decompressobj(-15), b""
        self.inflated = 0

    def _more(self, most: int) -> bool:
        data = self.engine.unconsumed_tail or self.file.read(min(self.left, 1 << 16))
        if not self.engine.unconsumed_tail:
            self.left -= len(data)
        piece = b"" if self.engine.eof else self.engine.decompress(data, most)
        self.inflated += len(piece)
        self.held += piece
        return bool(piece or data)

    def lines(self) -> Iterator[bytes]:
        while True:
            while (at := self.held.find(b"\n")) < 0:
                if not self._more(512):
                    return
            line, self.held = self.held[: at + 1], self.held[at + 1 :]
            yield line

    def read(self, size: int) -> bytes:
        parts, got = [self.held], len(self.held)
        while got < size:
            self.held = b""
            if not self._more(min(size - got, 1 << 20)):
                break
            parts.append(self.held)
            got += len(self.held)
        whole = b"".join(parts)
        self.held = whole[size:]
        return whole[:size]


def parse_members(file, wanted, payload) -> Iterator[dict]:
    """``parse_records`` of a file of gzip members; payloads that are not asked for are passed over on disk."""
    at = 0
    while True:
        file.seek(at)
        head = file.read(_START)
        if not head:
            return
        size = struct.unpack("<I", head[16:20])[0] if head[:4] == _MAGIC and head[12:16] == _FIELD else 0
        if size <= _START:  # another tool's member: no length to go by
            file.seek(at)
            yield from parse_records(gzip.open(io.BufferedReader(_Uncloseable(file))), wanted, payload)
            return
        body = _Inflated(file, size - _START - 8)
        found = parse_head(body.lines())
        if found and wanted(found[0]):
            record, length = found
            if payload(record):
                record["payload"] = body.read(length)
                if len(record["payload"]) < length:
                    raise ValueError("a record ends before its Content-Length")
            yield record
        at += size


class _Uncloseable(io.RawIOBase):
    """The rest of a file as a plain stream; closing it leaves the file open."""

    def __init__(self, file):
        self.file = file

    def readinto(self, room) -> int:
        data = self.file.read(len(room))
        room[: len(data)] = data
        return len(data)

    def readable(self) -> bool:
        return True


# -- data source -------------------------------------------------------------
@dataclass
class FilePartition(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        asked = str(options.get("payload", "true"))
        #: None: all payloads; else the record types whose payload is asked for.
        self.types = None if asked.lower() == "true" else set() if asked.lower() == "false" else {t.strip() for t in asked.split(",")}
        self.files_each = int(options.get("filesPerPartition", "1"))
        self.equal: dict[str, set] = {}

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.equal[name] = self.equal[name] & values if name in self.equal else values
            else:
                yield f

    def partitions(self):
        fs, root = _fs(self.path)
        files: set[str] = set()
        found = fs.get_file_info(pa.fs.FileSelector(root, allow_not_found=True))
        manifests = [f.path for f in found if f.base_name.startswith("_manifest-")]
        for m in manifests:
            with fs.open_input_stream(m) as s:
                files |= {f"{root}/{name}" for name in json.loads(s.read())}
        if not manifests:  # an archive written by another tool
            files = {f.path for f in found if f.base_name.endswith((".warc", ".warc.gz"))}
        names = sorted(files)
        return [FilePartition(names[i : i + self.files_each]) for i in range(0, len(names), self.files_each)] or [FilePartition([])]

    def read(self, partition: FilePartition):
        fs, _ = _fs(self.path)
        equal = self.equal
        wanted = (lambda h: all(h.get(k) in v for k, v in equal.items())) if equal else (lambda h: True)
        types = self.types
        payload = lambda h: types is None or h.get("warc_type") in types
        names = [*HEADERS, "payload"]
        schema = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload", pa.binary())])
        for name in partition.files:
            with fs.open_input_file(name) as file:
                rows, held = [], 0
                records = parse_members(file, wanted, payload) if name.endswith(".gz") else parse_records(io.BufferedReader(_Uncloseable(file)), wanted, payload)
                for r in records:
                    rows.append(r)
                    held += len(r.get("payload", b"")) + 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pydict({n: [x.get(n) for x in rows] for n in names}, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict({n: [x.get(n) for x in rows] for n in names}, schema)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator):
        fs, root = _fs(self.path)
        name, out = f"part-{uuid.uuid4().hex}.warc.gz", None
        for row in iterator:
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(packed(record(row.asDict())))
        if out is not None:
            out.close()
        return Written(name if out is not None else None)

    def commit(self, messages):
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        manifest, keep = f"_manifest-{uuid.uuid4().hex}.json", {m.name for m in messages if m and m.name}
        before = [f.path for f in fs.get_file_info(pa.fs.FileSelector(root)) if f.base_name not in keep and f.is_file]
        with fs.open_output_stream(f"{root}/.{manifest}") as s:
            s.write(json.dumps(sorted(keep)).encode())
        fs.move(f"{root}/.{manifest}", f"{root}/{manifest}")
        if self.overwrite:  # the new manifest stands; old manifests go before their files
            for path in sorted(before, key=lambda p: "_manifest-" not in p):
                fs.delete_file(path)

    def abort(self, messages):
        fs, root = _fs(self.path)
        for m in messages:
            if m and m.name:
                fs.delete_file(f"{root}/{m.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# -- pages -------------------------------------------------------------------
def page_records(pages: DataFrame, id_column: str = "page_id", uri_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Rows for the writer: of equal payloads of LEAST_SHARED bytes or more the smallest id is the response.

    Digests are grouped by minimum (pre-aggregated) and joined back without
    the payloads; the payload meets its decision once, by page.  Repeated ids
    with one payload are the same page and give a response each.
    """
    kind = pages.schema[id_column].dataType
    plain = pages.select(F.col(id_column).alias("id"), F.col(uri_column).alias("uri"), F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")).alias("payload"))
    marked = plain.select("id", "uri", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("bigint").alias("size"))
    shared = marked.where((F.col("size") >= LEAST_SHARED) & F.col("id").isNotNull()).select("id", "digest")
    firsts = shared.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("digest", "first")
    revisits = shared.distinct().join(firsts, "digest").where("id > first").select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "first")
    # A merge join at every size: the list of revisits grows with the input.
    joined = marked.join(revisits.hint("merge"), (F.col("id") == F.col("rid")) & (F.col("digest") == F.col("rdigest")), "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    again = F.col("first").isNotNull()
    assert kind.simpleString() in ("bigint", "int", "string")
    return joined.select(
        urn(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("warc_type"),
        F.col("uri").cast("string").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.col("size").cast("string").alias("payload_length"),
        urn(F.col("first")).alias("refers_to"),
        F.when(again, F.lit(None).cast("string")).otherwise("text/html; charset=utf-8").alias("content_type"),
        F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, folder: str | None = None, **columns) -> str:
    """Write the archive of a page table; returns its folder."""
    spark = pages.sparkSession
    register(spark)
    folder = qualified(spark, folder or scratch(spark, "warc"))
    page_records(pages, **columns).write.format("warc").mode("append").save(folder)
    return folder


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id string, payload_bytes, payload_digest, record_type, refers_to string) from an archive.

    One scan: responses give their payloads, from which size and digest are
    worked out; of revisits only the headers are inflated.
    """
    register(spark)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit(""))
    rows = spark.read.format("warc").option("payload", "response").load(qualified(spark, folder)).where("warc_type IN ('response', 'revisit')")
    whole = F.col("warc_type") == "response"
    size = F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("bigint")
    digest = F.when(whole, F.sha2("payload", 256)).otherwise(F.regexp_extract("payload_digest", "^sha256:(.*)$", 1))
    return rows.select(page("record_id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to"))

