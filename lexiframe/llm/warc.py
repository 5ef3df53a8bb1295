"""WARC archives as a Python data source: one partition a file, filters on headers, lazy payloads.

Archives are gzip files with one member a record. Members written here carry their length in the
gzip header, so a reader inflates the WARC header only, and steps over a record that no filter
wants; members of other writers are inflated to their end. Reading and writing go through Arrow's
file systems, so a path may be any URI they know.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from lexiframe.llm.shared import attach, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = """record_type string, record_id string, target_uri string, warc_date string,
 payload_digest string, refers_to string, content_length long, headers map<string,string>, payload binary"""

#: Columns that come from a header, and the header.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}

# Fixed values of the gzip format: magic, deflate, extra field present; subfield "sl" has lengths.
_GZIP = b"\x1f\x8b\x08\x04" + b"\0" * 6
_EXTRA, _EXTRA_SIZE = "<2sHI", 8
_CHUNK = 64 << 10


def member(record: bytes, level: int = 1) -> bytes:
    """A gzip member that tells how long it is."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    size = len(_GZIP) + 2 + _EXTRA_SIZE + len(body) + len(tail)
    return _GZIP + struct.pack("<H", _EXTRA_SIZE) + struct.pack(_EXTRA, b"sl", 4, size) + body + tail


def record(headers: dict[str, str], payload: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(payload)}"]
    return "\r\n".join([*lines, "", ""]).encode() + payload + b"\r\n\r\n"


def parse_headers(block: bytes) -> dict[str, str]:
    """Headers by name; a repeated header keeps its first value, folded lines are joined."""
    found: dict[str, str] = {}
    name = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip() if colon else None
        if name and name not in found:
            found[name] = value.strip()
    return found


class _Bytes:
    """Buffered bytes of one file, plain or gzip, with cheap steps over whole members."""

    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size
        self.stream.seek(0)
        self.gzip = self.stream.read(2) == _GZIP[:2]
        self.begin(0)

    def begin(self, place: int) -> None:
        """Go to the member, or the byte, at `place` of the file."""
        self.place, self.data = place, b""
        self.inflate, self.next, self.finished, self.told = None, None, False, False
        self.stream.seek(place)
        if self.gzip and place < self.size:
            head = self.stream.read(len(_GZIP) + 2 + _EXTRA_SIZE)
            if head[3:4] == b"\x04" and head[12:14] == b"sl":
                self.next, self.told = place + struct.unpack_from(_EXTRA, head, 12)[2], True
            self.inflate = zlib.decompressobj(31)
            self.stream.seek(place)

    def more(self, most: int) -> bool:
        """Up to about `most` further bytes in `data`; False at the end."""
        while True:
            if self.inflate is None:
                got = self.stream.read(min(_CHUNK, most)) if not self.gzip else b""
                self.data += got
                return bool(got)
            if self.inflate.eof:
                left = self.inflate.unused_data
                place = self.stream.tell() - len(left)
                self.finished = True
                self.next = self.next or place
                return False
            source = self.inflate.unconsumed_tail or self.stream.read(_CHUNK)
            if not source:
                raise ValueError("a gzip member ends early")
            got = self.inflate.decompress(source, most)
            self.data += got
            if got:
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.data.find(mark)
        while at < 0:
            if not self.more(2048):
                return None
            at = self.data.find(mark)
        head, self.data = self.data[:at], self.data[at + len(mark) :]
        return head

    def take(self, n: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < n:
            self.data = b""
            if not self.more(min(n - have, 1 << 20)):
                raise ValueError("a record ends early")
            parts.append(self.data)
            have += len(self.data)
        whole = b"".join(parts)
        self.data = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        while len(self.data) < n:
            n -= len(self.data)
            self.data = b""
            if not self.gzip and n > _CHUNK:
                self.stream.seek(n, 1)
                return
            if not self.more(min(n, 1 << 20)):
                raise ValueError("a record ends early")
        self.data = self.data[n:]

    def next_member(self) -> bool:
        """Step to the next member; one that tells its length is not inflated further."""
        if self.next is None:
            while self.more(1 << 20):
                self.data = b""
        if self.next >= self.size:
            return False
        self.begin(self.next)
        return True


def records(stream, size: int, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    """(headers, length, payload) of records whose headers `wanted` accepts.

    A gzip member that tells its length holds one record, as written here and as the format asks
    for, and is left by that length; any other member may hold several records and is read to its end.
    """
    if not size:
        return
    source = _Bytes(stream, size)
    while True:
        block = source.until(b"\r\n\r\n")
        if block is None:
            if source.gzip and source.next_member():
                continue
            return
        if source.gzip and not block.strip(b"\r\n"):
            continue  # the end of the record before
        headers = parse_headers(block.lstrip(b"\r\n"))
        length = int(headers.get("Content-Length", 0))
        accepted = wanted(headers)
        payload = source.take(length) if accepted and payloads else None
        if accepted:
            yield headers, length, payload
        if source.told:
            if not source.next_member():
                return
        elif source.gzip:
            source.skip(0 if payload is not None else length)
        else:
            source.skip((0 if payload is not None else length) + 4)


@dataclass
class FilePart(InputPartition):
    path: str
    size: int


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class WarcReader(DataSourceReader):
    """Options: path; payloads=false leaves `payload` null and inflates no payload."""

    def __init__(self, options: dict):
        self.uri = options["path"]
        self.payloads = options.get("payloads", "true").lower() != "false"
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            header = self._header(getattr(one, "attribute", ()))
            if header and isinstance(one, EqualTo):
                self.tests.append((header, "in", (one.value,)))
            elif header and isinstance(one, In):
                self.tests.append((header, "in", tuple(one.value)))
            elif header and isinstance(one, StringStartsWith):
                self.tests.append((header, "starts", (one.value,)))
            else:
                yield one

    @staticmethod
    def _header(attribute: tuple) -> str | None:
        if len(attribute) == 1:
            return HEADERS.get(attribute[0])
        return attribute[1] if len(attribute) == 2 and attribute[0] == "headers" else None

    def partitions(self) -> list[FilePart]:
        system, path = _file_system(self.uri)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.uri)
        if info.type == fs.FileType.File:
            return [FilePart(path, info.size)]
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        names = [i for i in found if i.is_file and "/_" not in i.path[len(path) :]]
        names = [i for i in names if i.base_name.endswith((".warc", ".warc.gz"))]
        return [FilePart(i.path, i.size) for i in sorted(names, key=lambda i: i.path)]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, values in self.tests:
            value = headers.get(name)
            if value is None:
                return False
            if not (value in values if kind == "in" else value.startswith(values)):
                return False
        return True

    def read(self, part: FilePart | None) -> Iterator[tuple]:
        if part is None:  # a folder without archives
            return
        system, _ = _file_system(self.uri)
        with system.open_input_file(part.path) as stream:
            for headers, length, payload in records(stream, part.size, self._wanted, self.payloads):
                known = [headers.get(name) for name in HEADERS.values()]
                yield (*known, length, headers, payload)


@dataclass
class Written(WriterCommitMessage):
    parts: list


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of `SCHEMA`; files get their names when the whole job commits, so tasks that are
    repeated or lost leave nothing that a reader sees."""

    def __init__(self, options: dict, overwrite: bool):
        self.uri, self.level = options["path"], int(options.get("level", 1))
        self.most = int(options.get("file_bytes", 128 << 20))
        self.job = uuid.uuid4().hex
        if overwrite:
            raise ValueError("archives are only appended to a new or existing folder")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = _file_system(self.uri)
        folder = f"{root}/_staging/{self.job}"
        system.create_dir(folder, recursive=True)
        done, out, size = [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    done.append(f"{folder}/{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(done[-1], compression=None), 0
                headers = {name: row[column] for column, name in HEADERS.items() if row[column]}
                headers |= {k: v for k, v in row["headers"] or () if k not in headers and k != "Content-Length"}
                data = member(record(headers, row["payload"] or b""), self.level)
                out.write(data)
                size += len(data)
                if size >= self.most:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(done)

    def commit(self, messages: list) -> None:
        system, root = _file_system(self.uri)
        system.create_dir(root, recursive=True)
        names = [path for message in messages if message for path in message.parts]
        for number, path in enumerate(names):
            system.move(path, f"{root}/{self.job}-{number:06d}.warc.gz")

    def abort(self, messages: list) -> None:
        """Nothing was moved; staged files stay out of sight of readers."""


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0
) -> DataFrame:
    """Rows of `SCHEMA` for the pages: of equal payloads of at least `least` bytes the smallest id is
    the response, the others are revisits without a payload.

    A null body is empty. Rows that repeat an id are one page if their payloads are equal (all are
    responses then); a null id comes after all others, and a payload of null ids only is a response
    each time. Payloads are equal if their SHA-1, SHA-256 and lengths are.
    """
    body = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), body.alias("_body")
    ).withColumn("_key", F.concat_ws(":", F.sha1("_body"), F.sha2("_body", 256), F.octet_length("_body")))
    groups = rows.groupBy("_key").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    groups = stored(groups, "payload-groups")
    # Only pages that are revisits need to be told; the narrow rows are joined, not the bodies.
    placed = attach(rows.select("_id", "_key"), groups, "_key", "_n")
    late = placed.filter(F.coalesce(F.col("_id") != F.col("_first"), F.col("_first").isNotNull()))
    late = late.select(F.col("_id").alias("_late"), F.col("_key").alias("_late_key"), "_first").distinct()
    same = rows["_id"].eqNullSafe(late["_late"]) & (rows["_key"] == late["_late_key"])
    joined = rows.join(late, same, "left")
    revisit = F.col("_first").isNotNull() & (F.octet_length("_body") >= least)
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.format_string("<urn:page:%s>", F.coalesce(F.col("_id").cast("string"), F.lit(""))).alias("record_id"),
        F.regexp_replace("_url", r"[\r\n]", "").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.concat(F.lit("sha1:"), _base32(F.sha1("_body"))).alias("payload_digest"),
        F.when(revisit, F.format_string("<urn:page:%s>", F.col("_first").cast("string"))).alias("refers_to"),
        F.lit(0).cast("long").alias("content_length"),
        F.create_map(
            F.lit("X-Payload-Length"), F.octet_length("_body").cast("string")
        ).alias("headers"),
        F.when(~revisit, F.col("_body")).alias("payload"),
    )


def _base32(hexadecimal):
    """Base 32 of a SHA-1 in hexadecimal: 8 groups of 20 bits, 4 characters each."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for group in range(8):
        bits = F.conv(F.substring(hexadecimal, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            five = F.shiftright(bits, shift).bitwiseAND(31)
            parts.append(F.substr(alphabet, five + 1, F.lit(1)))
    return F.concat(*parts)


def write_warc(rows: DataFrame, path: str, **options: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").options(**options).mode("append").save(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as the archives have them.

    Payloads of responses are read and hashed; records of revisits have none, so the length and
    digest of the full payload stand in their headers.
    """
    found = read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")
    response = F.col("record_type") == "response"
    return found.select(
        number(F.col("record_id")).alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long"))
        .otherwise(F.col("headers")["X-Payload-Length"].cast("long"))
        .alias("payload_bytes"),
        F.when(response, _base32(F.sha1("payload")))
        .otherwise(F.regexp_replace("payload_digest", "^sha1:", ""))
        .alias("payload_digest"),
        "record_type",
        number(F.col("refers_to")).alias("refers_to"),
    )
