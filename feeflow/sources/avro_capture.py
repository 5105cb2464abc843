"""Captured messages from Avro container files, as a Spark data source.

The capture service writes Avro; where the spark-avro package is on the class
path, ``read_capture(fmt="avro")`` uses it.  This source needs no package: it
reads the three capture columns (sequence number, enqueue time, body) of each
record and skips the others by their schema, which covers what capture files
hold (primitives, strings, bytes, maps, arrays, unions, records) and no more:
no logical types, no schema resolution, codecs ``null`` and ``deflate``.

A file is planned as byte ranges.  Blocks of a container file end with the
file's 16-byte sync marker, so a range begins behind the first marker at or
after its start and ends with the block that begins before its end: each block
is read by exactly one task, however large the file.  A file that is cut short
or no Avro fails the read with its name.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAGIC = b"Obj\x01"
SYNC = 16
SPLIT_BYTES = 32 << 20
ROWS = 4096
COLUMNS = {"SequenceNumber": pa.int64(), "EnqueuedTimeUtc": pa.string(), "Body": pa.binary()}
FIXED = {"float": 4, "double": 8, "boolean": 1, "null": 0}


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Bytes:
    """Avro's binary encoding, read from one buffer."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def long(self) -> int:
        value = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return (value >> 1) ^ -(value & 1)
            shift += 7

    def raw(self) -> bytes:
        size = self.long()
        if size < 0 or self.at + size > len(self.data):
            raise ValueError("a value runs over its block's end")
        self.at += size
        return self.data[self.at - size: self.at]

    def value(self, schema):
        """The next value: numbers, strings and bytes as they are; None for
        anything that a capture column cannot hold, which is skipped."""
        kind = schema["type"] if isinstance(schema, dict) else schema
        if isinstance(kind, (dict, list)) and not isinstance(schema, list):
            return self.value(kind)
        if isinstance(schema, list):
            return self.value(schema[self.long()])
        if kind in ("int", "long"):
            return self.long()
        if kind == "string":
            return self.raw().decode("utf-8")
        if kind == "bytes":
            return self.raw()
        if kind in FIXED:
            self.at += FIXED[kind]
        elif kind == "fixed":
            self.at += schema["size"]
        elif kind == "enum":
            self.long()
        elif kind == "record":
            for f in schema["fields"]:
                self.value(f["type"])
        elif kind in ("map", "array"):
            inner = schema["values"] if kind == "map" else schema["items"]
            while n := self.long():
                if n < 0:           # the block's size in bytes comes with it
                    n, _ = -n, self.long()
                for _ in range(n):
                    if kind == "map":
                        self.raw()
                    self.value(inner)
        else:
            raise ValueError(f"Avro type {kind!r} is not part of capture files")
        return None


@dataclass
class Header:
    schema: dict
    codec: str
    sync: bytes
    size: int


def read_header(stream, size: int) -> Header:
    """The schema, codec and sync marker; ``stream`` stands at the file's start."""
    length = min(size, 1 << 16)
    while True:
        stream.seek(0)
        head = Bytes(stream.read(length))
        if head.data[:4] != MAGIC:
            raise ValueError("no Avro container file")
        head.at, found = 4, {}
        try:
            while n := head.long():
                if n < 0:
                    n, _ = -n, head.long()
                for _ in range(n):
                    key = head.raw().decode()
                    found[key] = head.raw()
            if head.at + SYNC > len(head.data):
                raise IndexError
            break
        except (IndexError, ValueError):
            if length >= size:
                raise ValueError("the file header is cut short") from None
            length = min(size, length * 4)      # a long schema
    codec = found.get("avro.codec", b"null").decode()
    if codec not in ("null", "deflate"):
        raise ValueError(f"codec {codec!r}")
    return Header(json.loads(found["avro.schema"]), codec, head.data[head.at: head.at + SYNC], head.at + SYNC)


def _first_block(stream, header: Header, start: int, size: int) -> int:
    """Where the first block that begins at or after ``start`` begins."""
    if start <= header.size:
        return header.size
    at, kept = start - SYNC, b""
    while at < size:
        stream.seek(at + len(kept))
        more = stream.read(1 << 20)
        if not more:
            return size
        data = kept + more
        found = data.find(header.sync)
        if found >= 0:
            return at + found + SYNC
        kept = data[-(SYNC - 1):]
        at += len(data) - len(kept)
    return size


def _long_at(stream) -> int:
    value = shift = 0
    while True:
        byte = stream.read(1)
        if not byte:
            raise ValueError("the file is cut short")
        value |= (byte[0] & 0x7F) << shift
        if byte[0] < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7


def read_range(part: ByteRange) -> Iterator[pa.RecordBatch]:
    """The records of the blocks that begin in a byte range, column by column."""
    system, path = _file_system(part.path)
    with system.open_input_file(path) as stream:
        try:
            size = stream.size()
            header = read_header(stream, size)
            fields = [(f["name"], f["type"]) for f in header.schema["fields"]]
            rows: dict[str, list] = {name: [] for name in COLUMNS}
            at = _first_block(stream, header, part.start, size)
            while at < min(part.end, size):
                stream.seek(at)
                count, length = _long_at(stream), _long_at(stream)
                data = stream.read(length)
                if len(data) < length or stream.read(SYNC) != header.sync:
                    raise ValueError("the file is cut short, or a block is broken")
                at = stream.tell()
                block = Bytes(zlib.decompress(data, -15) if header.codec == "deflate" else data)
                for _ in range(count):
                    record = {name: block.value(kind) for name, kind in fields}
                    for name in COLUMNS:
                        rows[name].append(record.get(name))
                    if len(rows["Body"]) >= ROWS:
                        yield _batch(rows)
                        rows = {name: [] for name in COLUMNS}
        except (ValueError, IndexError, KeyError, zlib.error) as e:
            raise ValueError(f"{part.path}: {e}") from e
        if rows["Body"]:
            yield _batch(rows)


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in COLUMNS.items()], names=list(COLUMNS))


class CaptureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[ByteRange]:
        from pyarrow import fs

        system, path = _file_system(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else [
            f for f in system.get_file_info(fs.FileSelector(path, recursive=True))
            if f.is_file and not f.base_name.startswith((".", "_"))]
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        return [ByteRange(f"{prefix}{f.path}", start, min(start + self.split, f.size))
                for f in sorted(files, key=lambda f: f.path) for start in range(0, f.size, self.split)] or [
            ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return read_range(partition) if partition.path else iter(())


class AvroCapture(DataSource):
    """``spark.read.format("avro_capture").load(folder)``; option ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "avro_capture"

    def schema(self) -> str:
        return "SequenceNumber long, EnqueuedTimeUtc string, Body binary"

    def reader(self, schema) -> CaptureReader:
        return CaptureReader({k.lower(): v for k, v in self.options.items()})


def read_avro_capture(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All messages of the Avro files below ``path`` (any file name)."""
    spark.dataSource.register(AvroCapture)
    return spark.read.format("avro_capture").option("splitBytes", str(split_bytes)).load(path)
