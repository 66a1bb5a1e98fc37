"""WARC archives as a Spark data source, and archives of pages without repeated payloads.

``spark.dataSource.register(WarcDataSource)``, then ``spark.read.format("warc").load(folder)`` and
``df.write.format("warc").save(folder)``. Reading plans partitions of whole files by their size, parses a
record's headers first, and inflates no further where the record type or a header predicate rules the
record out or the schema asks for nothing of the payload: members that this module wrote carry their size,
so that the reader seeks to the next one. Files are written record by record and count only when the
job commits, so repeated tasks leave nothing behind that a reader would see.
"""

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
from pyspark.sql import types as T
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

from nearfield.llm.common import skewed_join
from nearfield.scratch import scratch_dir

SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_length", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("read_digest", T.StringType()),
        T.StructField("read_length", T.LongType()),
    ]
)
#: Columns that need the payload itself; the last two are the digest and length of what was read.
OF_PAYLOAD = ("payload", "read_digest", "read_length")
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files.json"
PARTITION_BYTES, ROLL_BYTES, CHUNK = 64 << 20, 256 << 20, 64 << 10
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
#: The extra field of a gzip member that holds the member's size.
SIZE_FIELD = b"WL"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


# ---- one record


def _line(text: str) -> str:
    """A header value: no line breaks or other control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record_bytes(
    record_id: str, record_type: str, target_uri: str | None, date: str, refers_to: str | None, digest: str, length: int, payload: bytes
) -> bytes:
    """A response or revisit record; the revisit's block ends with the HTTP headers, which tell the length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = record_type == "revisit"
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_line(record_id)}", f"WARC-Date: {date}"]
    if target_uri is not None:
        lines.append(f"WARC-Target-URI: {_line(target_uri)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_line(refers_to or '')}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member that tells its own size in an extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(raw) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + SIZE_FIELD + struct.pack("<HQ", 8, size)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def _member_size(head: bytes) -> int | None:
    """What the extra field says, if there is one."""
    if len(head) < 12 or not head[3] & 4:
        return None
    (extra,) = struct.unpack_from("<H", head, 10)
    at, end = 12, min(12 + extra, len(head))
    while at + 4 <= end:
        (size,) = struct.unpack_from("<H", head, at + 2)
        if head[at : at + 2] == SIZE_FIELD and size == 8 and at + 12 <= end:
            return struct.unpack_from("<Q", head, at + 4)[0]
        at += 4 + size
    return None


def _headers(raw: bytes) -> dict[str, str]:
    """Header lines after the first; folded lines continue the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class _Source:
    """The bytes of one record after the other, from a plain or a gzipped file."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size
        self.gzipped = file.read(2) == b"\x1f\x8b"
        self.at = 0  # where the record begins

    def begin(self) -> bool:
        """Goes to the record; False at the end of the file."""
        if self.at >= self.size:
            return False
        self.file.seek(self.at)
        self.raw, self.done = b"", False
        if self.gzipped:
            self.inflate, self.member, self.fed = zlib.decompressobj(31), None, 0
        return True

    def more(self) -> bool:
        """Reads on; False if the record's member or the file has no more."""
        if self.done:
            return False
        data = self.file.read(CHUNK)
        if not self.gzipped:
            self.raw += data
            self.done = not data
            return bool(data)
        if not self.fed:
            self.member = _member_size(data)
        self.fed += len(data)
        self.raw += self.inflate.decompress(data)
        self.done = self.inflate.eof or not data
        return True

    def until(self, mark: bytes, start: int = 0) -> int:
        """Place after the first ``mark`` from ``start`` on, or -1."""
        while (found := self.raw.find(mark, start)) < 0:
            if not self.more():
                return -1
        return found + len(mark)

    def take(self, start: int, stop: int) -> bytes:
        while len(self.raw) < stop and self.more():
            pass
        return self.raw[start:stop]

    def skip_to(self, end: int) -> None:
        """Leaves a record whose block ends at ``end`` of its plain bytes."""
        if not self.gzipped:
            self.at += end + 4
        elif self.member:
            self.at += self.member
        else:  # the member's end shows only by inflating it
            while not self.inflate.eof:
                data = self.file.read(CHUNK)
                if not data:
                    self.at = self.size
                    return
                self.fed += len(data)
                self.inflate.decompress(data)
            self.at += self.fed - len(self.inflate.unused_data)


def read_records(file: pa.NativeFile, size: int, columns: list[str], wanted) -> Iterator[list]:
    """Values of ``columns`` for the records whose headers ``wanted`` accepts.

    A file that breaks off inside a record ends with the last whole one.
    """
    source = _Source(file, size)
    payloads = any(c in OF_PAYLOAD for c in columns)
    while source.begin():
        head = source.until(b"\r\n\r\n")
        if head < 0 or not source.raw.startswith(b"WARC/"):
            return
        headers = _headers(source.raw[: head - 4])
        values: dict = {c: headers.get(h) for c, h in HEADERS.items()}
        digest = values["payload_digest"] or ""
        values["payload_digest"] = digest.split(":", 1)[1] if digest.lower().startswith("sha1:") else digest or None
        end = head + int(headers.get("content-length") or 0)
        if wanted(values):
            start = head
            if headers.get("content-type", "").startswith("application/http"):
                stop = source.until(b"\r\n\r\n", head)
                if 0 <= stop <= end:
                    http = _headers(source.raw[head : stop - 4])
                    values["payload_length"] = int(http["content-length"]) if http.get("content-length", "").isdecimal() else None
                    start = stop
            else:
                values["payload_length"] = end - head
            if payloads and values["record_type"] != "revisit":
                payload = source.take(start, end)
                values["payload"], values["read_length"] = payload, len(payload)
                if "read_digest" in columns:
                    values["read_digest"] = base32_sha1(payload)
            yield [values.get(c) for c in columns]
        source.skip_to(end)


# ---- the data source


@dataclass
class _Files(InputPartition):
    paths: list[tuple[str, int]]

    def __init__(self, paths: list[tuple[str, int]]):
        self.paths = paths


def plan_files(sizes: list[tuple[str, int]], target: int = PARTITION_BYTES) -> list[list[tuple[str, int]]]:
    """Whole files in groups of about ``target`` bytes; larger ones alone."""
    groups: list[list[tuple[str, int]]] = []
    room = 0
    for path, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        if groups and size <= room:
            groups[-1].append((path, size))
            room -= size
        else:
            groups.append([(path, size)])
            room = target - size
    return groups


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        unknown = [c for c in columns if c not in SCHEMA.names]
        if unknown:
            raise ValueError(f"no such columns of a WARC record: {unknown}")
        self.path, self.columns, self.tests = path, columns, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over predicates on header columns; Spark keeps the rest."""
        for f in filters:
            attribute = getattr(f, "attribute", ())
            if len(attribute) == 1 and attribute[0] in HEADERS and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                value = getattr(f, "value", None)
                self.tests.append((attribute[0], type(f).__name__, list(value) if isinstance(value, tuple) else value))
            else:
                yield f

    def accepts(self, values: dict) -> bool:
        for column, test, wanted in self.tests:
            value = values[column]
            if value is None or test == "EqualTo" and value != wanted or test == "In" and value not in wanted:
                return False
            if test == "StringStartsWith" and not value.startswith(wanted):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        filesystem, folder = _filesystem(self.path)
        manifest = f"{folder}/{MANIFEST}"
        if filesystem.get_file_info(manifest).type == pafs.FileType.File:
            with filesystem.open_input_stream(manifest) as file:
                sizes = [(f"{folder}/{name}", size) for name, size in json.loads(file.read())]
        else:
            found = filesystem.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
            if not found:
                found = [filesystem.get_file_info(folder)]
            sizes = [(f.path, f.size) for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz"))]
        return [_Files(group) for group in plan_files(sizes) or [[]]]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(self.path)
        schema = pa.schema([(c, {T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}.get(SCHEMA[c].dataType, pa.string())) for c in self.columns])
        rows: list[list] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

        for path, size in partition.paths:
            with filesystem.open_input_file(path) as file:
                for row in read_records(file, size, self.columns, self.accepts):
                    rows.append(row)
                    held += sum(len(v) for v in row if isinstance(v, bytes))
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Columns: record_id, record_type, target_uri, date, refers_to, payload_digest, payload_length, payload."""

    def __init__(self, path: str, level: int):
        self.path, self.level = path, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, folder = _filesystem(self.path)
        filesystem.create_dir(folder, recursive=True)
        files: list[tuple[str, int]] = []
        out, size = None, 0
        for batch in iterator:
            names = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_length", "payload"]
            for row in zip(*(batch.column(batch.schema.get_field_index(n)) for n in names), strict=True):
                values = [v.as_py() for v in row]
                member = gzip_member(record_bytes(*values[:7], values[7] or b""), self.level)
                if out is None:
                    files.append((f"part-{uuid.uuid4().hex}.warc.gz", 0))
                    out = filesystem.open_output_stream(f"{folder}/{files[-1][0]}", compression=None)
                out.write(member)
                size += len(member)
                files[-1] = (files[-1][0], size)
                if size >= ROLL_BYTES:
                    out.close()
                    out, size = None, 0
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, folder = _filesystem(self.path)
        filesystem.create_dir(folder, recursive=True)
        manifest, files = f"{folder}/{MANIFEST}", [f for m in messages if m for f in m.files]
        if filesystem.get_file_info(manifest).type == pafs.FileType.File:
            with filesystem.open_input_stream(manifest) as file:
                files = json.loads(file.read()) + files
        with filesystem.open_output_stream(manifest) as file:
            file.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, folder = _filesystem(self.path)
        for name, _ in [f for m in messages if m for f in m.files]:
            filesystem.delete_file(f"{folder}/{name}")


class WarcDataSource(DataSource):
    """Options: path; level (of compression, when writing). A schema of some columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema.names)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder")
        return WarcWriter(self.options["path"], int(self.options.get("level", "6")))


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records below ``path``; only ``columns`` are read. Filters on header columns reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc")
    if columns:
        reader = reader.schema(T.StructType([SCHEMA[c] for c in columns]))
    return reader.load(path)


def write_warc(records: DataFrame, path: str) -> None:
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode("append").save(path)


# ---- pages


def _urn(column: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def page_records(pages: DataFrame, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """A WARC record for each row of page_id, url, html (null: empty).

    Of equal payloads of at least ``min_bytes`` the one of the largest page_id is the response (all of
    them, if its row is repeated), the others revisit it; null page_ids are smaller than any other, and
    if all are null, each is a response.
    """
    own = pages.select(
        "page_id", F.col("url").alias("target_uri"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    )
    own = own.withColumn("_sha1", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    holders = own.where(F.col("payload_length") >= min_bytes).groupBy("_sha1").agg(F.max("page_id").alias("_holder"))
    joined = skewed_join(own, holders, ["_sha1"], "left")
    revisit = F.col("_holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_holder"))
    return joined.select(
        _urn("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        F.when(revisit, _urn("_holder")).alias("refers_to"),
        base32("_sha1").alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def base32(hexadecimal: str):
    """A column of hexadecimal digits, a multiple of five, in base 32: five digits make four letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(hexadecimal, at, 5), 16, 10).cast("int")
        parts += [F.substr(alphabet, F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` to the scratch folder and reads it back: page_id, payload_bytes,
    payload_digest, record_type, refers_to.

    Digest and length of responses are those of the payload that was read, of revisits what the record says.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_warc(page_records(pages), path)
    found = read_warc(
        spark, path, ["record_id", "record_type", "refers_to", "payload_digest", "payload_length", "read_digest", "read_length"]
    )
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) AS BIGINT)")
    return found.select(
        number("record_id").alias("page_id"),
        F.coalesce("read_length", "payload_length").alias("payload_bytes"),
        F.coalesce("read_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
