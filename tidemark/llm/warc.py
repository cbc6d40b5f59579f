"""WARC archives as a Spark data source: `format("warc")` reads and writes .warc.gz files, one gzip member a record."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    WriterCommitMessage,
)

from tidemark.session import new_path

HEAD_COLUMNS = ("record_type", "record_id", "target_uri", "payload_digest", "refers_to")
SCHEMA = ", ".join(f"{name} string" for name in HEAD_COLUMNS) + ", payload_bytes long, payload binary"
MANIFEST = "_records.json"
_ARCHIVES = (".warc", ".warc.gz")
#: Header names of a record and the subfield that holds a member's length.
_FIELDS = {
    "record_type": b"WARC-Type", "record_id": b"WARC-Record-ID", "target_uri": b"WARC-Target-URI",
    "payload_digest": b"WARC-Payload-Digest", "refers_to": b"WARC-Refers-To",
}
_LENGTH_FIELD = b"sl"
_DATE = b"1970-01-01T00:00:00Z"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIRST_READ = 1 << 16


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share (file, hdfs, s3, gs, or a plain path)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case, without prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(value: str | None) -> bytes:
    return "".join(c if " " < c != "\x7f" else "%20" if c == " " else "" for c in value or "").encode()


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    lines = [b"WARC/1.1"]
    lines += [name + b": " + _uri(row[column]) for column, name in _FIELDS.items() if row[column] is not None]
    if row["record_type"] == "revisit":
        lines.append(b"WARC-Profile: " + _PROFILE)
    lines += [
        b"WARC-Date: " + _DATE,
        b"X-Payload-Length: %d" % row["payload_bytes"],
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    """One gzip member whose header says how long it is, so that a reader can step over it."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 8 + len(body) + 8
    head = struct.pack("<4BIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255) + struct.pack("<H2sHI", 8, _LENGTH_FIELD, 4, total)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _member_length(head: bytes) -> int | None:
    """Length of the gzip member that begins so, if its header tells."""
    if len(head) < 20 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return None
    (size,) = struct.unpack_from("<H", head, 10)
    at, stop = 12, min(12 + size, len(head))
    while at + 4 <= stop:
        name, length = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == _LENGTH_FIELD and length == 4 and at + 8 <= stop:
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + length
    return None


class _Head(NamedTuple):
    fields: dict[bytes, str]
    block_at: int
    length: int


def _parse_head(data: bytes) -> _Head | None:
    """Header fields (names in lower case), where the block begins, its length; None while the header is incomplete."""
    stop = data.find(b"\r\n\r\n")
    if stop < 0:
        return None
    lines = data[:stop].split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    return _Head(fields, stop + 4, int(fields[b"content-length"]))


def _row(head: _Head) -> dict:
    row = {column: head.fields.get(name.lower()) for column, name in _FIELDS.items()}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    size = head.fields.get(b"x-payload-length")
    row["payload_bytes"] = int(size) if size else None
    return row


def _records(file: BinaryIO, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(row, block) of the wanted records of an archive.

    Headers are parsed first. A record that is not wanted, or whose payload isn't, is stepped over: its block is
    neither read nor unpacked where the length is known (plain records by Content-Length, members that tell theirs).
    """
    at, size = 0, file.size()
    while at < size:
        file.seek(at)
        first = file.read(2)
        if first == b"\x1f\x8b":
            file.seek(at)
            raw = file.read(4096)
            total = _member_length(raw)
            unpack = zlib.decompressobj(31)
            data, head = unpack.decompress(raw, 4096), None
            while (head := _parse_head(data)) is None:
                more = unpack.unconsumed_tail or file.read(4096)
                if not more:
                    raise ValueError(f"archive ends inside a record at byte {at}")
                data += unpack.decompress(more, 4096)
            row = _row(head)
            use = wanted(row)
            if not (use and with_payload) and total:
                at += total
                if use:
                    yield row, None
                continue
            parts = [data]
            while not unpack.eof:
                more = unpack.unconsumed_tail or file.read(_FIRST_READ)
                if not more:
                    raise ValueError(f"archive ends inside a record at byte {at}")
                parts.append(unpack.decompress(more))
            at = total + at if total else file.tell() - len(unpack.unused_data)
            if use:
                record = b"".join(parts)
                yield row, record[head.block_at : head.block_at + head.length] if with_payload else None
            continue
        file.seek(at)
        data = file.read(4096)
        if not data.strip(b"\r\n"):
            return
        while (head := _parse_head(data)) is None:
            more = file.read(4096)
            if not more:
                raise ValueError(f"archive ends inside a record at byte {at}")
            data += more
        row = _row(head)
        if wanted(row):
            file.seek(at + head.block_at)
            yield row, file.read(head.length) if with_payload else None
        at += head.block_at + head.length + 4


def _payload(row: dict, block: bytes) -> bytes:
    """The HTTP entity inside a record's block; the block itself where it holds no HTTP message."""
    if not block.startswith(b"HTTP/"):
        return block
    return block.partition(b"\r\n\r\n")[2]


class WarcSource(DataSource):
    """Options: path (folder or file); payload (true or false: whether payloads are read at all); verify (true: payloads
    of response records are checked against their digests); partition_bytes (archives are read together up to so many).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added; write to a new folder")
        return WarcWriter(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.allowed: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership on header columns are applied while headers are read; others go back to Spark."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEAD_COLUMNS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                name = f.attribute[0]
                self.allowed[name] = self.allowed[name] & values if name in self.allowed else values
            elif isinstance(f, IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in HEAD_COLUMNS:
                self.present.add(f.attribute[0])
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, path = open_store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.File:
            files = [info]
        else:
            found = store.get_file_info(fs.FileSelector(path))
            manifest = [f for f in found if f.base_name == MANIFEST]
            files = [f for f in found if f.base_name.endswith(_ARCHIVES) and f.type == fs.FileType.File]
            if manifest:  # files of attempts that failed are not in it
                with store.open_input_stream(manifest[0].path) as stream:
                    listed = set(json.loads(stream.read()))
                files = [f for f in files if f.base_name in listed]
        groups: list[list[str]] = []
        room = 0
        for f in sorted(files, key=lambda f: f.path):
            if not groups or f.size > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(f.path)
            room -= f.size
        return [InputPartition(g) for g in groups] or [InputPartition([])]

    def _wanted(self, row: dict) -> bool:
        return all(row[k] in v for k, v in self.allowed.items()) and all(row[k] is not None for k in self.present)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        store, _ = open_store(self.path)
        for path in partition.value:
            with store.open_input_file(path) as file:
                for row, block in _records(file, self._wanted, self.with_payload):
                    payload = None if block is None or row["record_type"] == "revisit" else _payload(row, block)
                    if self.verify and payload is not None and payload_digest(payload) != row["payload_digest"]:
                        raise ValueError(f"payload of {row['record_id']} does not match its digest")
                    size = row["payload_bytes"] if payload is None else len(payload)
                    yield (*(row[c] for c in HEAD_COLUMNS), size, payload)


class _Written(WriterCommitMessage):
    def __init__(self, name: str | None) -> None:
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    """One archive per task, under a name of its own; the manifest names those of the attempts that count."""

    def __init__(self, options) -> None:
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = open_store(self.path)
        name, stream = None, None
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, 128):
                    for row in batch.slice(at, 128).to_pylist():
                        if stream is None:
                            name = f"part-{uuid.uuid4().hex}.warc.gz"
                            store.create_dir(folder, recursive=True)
                            stream = store.open_output_stream(f"{folder}/{name}", compression=None)
                        stream.write(_member(_record(row)))
        finally:
            if stream is not None:
                stream.close()
        return _Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = open_store(self.path)
        store.create_dir(folder, recursive=True)
        listed = []
        if store.get_file_info(f"{folder}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{folder}/{MANIFEST}") as stream:
                listed = json.loads(stream.read())
        listed += [m.name for m in messages if m is not None and m.name]
        with store.open_output_stream(f"{folder}/{MANIFEST}") as stream:
            stream.write(json.dumps(listed).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = open_store(self.path)
        for m in messages:
            if m is not None and m.name and store.get_file_info(f"{folder}/{m.name}").type == fs.FileType.File:
                store.delete_file(f"{folder}/{m.name}")


def register(spark: SparkSession) -> None:
    """Make `format("warc")` known and let filters reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_base32(hex_digest):
    """Base32 of a 40-digit hexadecimal column, upper case."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 2), 40, "0") for i in range(4)])
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(
        *[F.substring(alphabet, F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)]
    )


def page_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Records (schema SCHEMA) of pages (page_id, url, html): a response per payload, revisits of it for equal pages.

    Among pages with equal payloads of at least `min_revisit_bytes`, the least page_id is the response. Repeated rows
    with that id are all responses. A null page is an empty payload; a null id stays behind ids, and refers to the
    least of them. Only digests are grouped; a payload is shuffled at most once.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    source = source.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = (
        source.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1 and first_id is not null")
        .drop("pages")
    )
    joined = source.join(first, "sha1", "left")
    revisit = (
        (F.col("payload_bytes") >= min_revisit_bytes)
        & F.col("first_id").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )

    def record_id(c: str):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record_id("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), with_base32(F.col("sha1"))).alias("payload_digest"),
        F.when(revisit, record_id("first_id")).alias("refers_to"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(records: DataFrame, path: str) -> None:
    """Write records as .warc.gz files below a new folder that driver and executors share."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """Records of a folder of archives (or one archive); filters on header columns are pushed down."""
    register(spark)
    options = {"payload": str(payload).lower(), "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).load(path)


def archive_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records, read back from the archives.

    Payloads of responses are unpacked and checked against their digests; of revisits only the headers are read.
    An empty table gives an empty folder of archives and an empty result; extra columns are ignored.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(page_records(pages, min_revisit_bytes), path)
    responses = read_archives(spark, path, verify=True).where("record_type = 'response'")
    revisits = read_archives(spark, path, payload=False).where("record_type = 'revisit'")

    def page_id(c: str):
        number = F.regexp_extract(c, "^<urn:x-page:(-?[0-9]*)>$", 1)
        return F.when(number != "", number.cast("long"))

    return responses.unionByName(revisits).select(
        page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id("refers_to").alias("refers_to"),
    )
