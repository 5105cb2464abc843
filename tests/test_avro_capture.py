"""Avro capture files, written here by the format's public rules."""

import json
import os
import random
import zlib

import pytest

from feeflow.operators import parse as P
from feeflow.sources import fixtures as X
from feeflow.sources.avro_capture import read_avro_capture
from paths import SF001

SCHEMA = {"type": "record", "name": "EventData", "fields": [
    {"name": "SequenceNumber", "type": "long"}, {"name": "Offset", "type": "string"},
    {"name": "EnqueuedTimeUtc", "type": "string"},
    {"name": "SystemProperties", "type": {"type": "map", "values": ["long", "double", "string", "bytes"]}},
    {"name": "Tags", "type": {"type": "array", "items": ["null", "boolean"]}},
    {"name": "Body", "type": ["null", "bytes"]}]}


def number(n):
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def raw(b):
    return number(len(b)) + b


def record(rnd, seq, time, body):
    out = number(seq) + raw(str(seq).encode()) + raw(time.encode())
    for i in range(rnd.randint(0, 2)):
        kind = rnd.randrange(4)
        out += number(1) + raw(f"k{i}".encode()) + number(kind) + [number(-5), b"\0" * 8, raw(b"xy"), raw(b"\1\2")][kind]
    out += number(0)
    if rnd.random() < 0.5:      # a block of two, its size given
        out += number(-2) + number(3) + number(0) + number(1) + b"\1"
    out += number(0)
    return out + (number(0) if body is None else number(1) + raw(bytes(body)))


def write(path, rows, codec="deflate", per_block=7, seed=1, cut=0):
    rnd = random.Random(seed)
    sync = rnd.randbytes(16)
    head = b"Obj\x01" + number(2) + raw(b"avro.schema") + raw(json.dumps(SCHEMA).encode())
    out = head + raw(b"avro.codec") + raw(codec.encode()) + number(0) + sync
    for i in range(0, len(rows), per_block):
        part = rows[i:i + per_block]
        data = b"".join(record(rnd, *r) for r in part)
        if codec == "deflate":
            squeezed = zlib.compressobj(wbits=-15)
            data = squeezed.compress(data) + squeezed.flush()
        out += number(len(part)) + raw(data) + sync
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(out[:len(out) - cut])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def messages(spark):
    return [tuple(r) for r in X.capture_from_orders(spark, SF001).collect()]


def test_files_are_read_in_ranges_and_equal_the_messages(spark, scratch, messages):
    rows = messages + [(-1, "9/17/2026 1:00:00 AM", None), (2**62, "", b"")]
    write(f"{scratch}/a/00/00.avro", rows[:400])
    write(f"{scratch}/a/01/no-extension", rows[400:], codec="null", per_block=1, seed=2)
    write(f"{scratch}/a/02/empty", [], seed=3)
    want = sorted(rows, key=str)
    for split in (2000, 17, 1 << 25):
        df = read_avro_capture(spark, f"{scratch}/a", split if split != 17 else 4099)
        got = sorted(((r[0], r[1], r[2]) for r in df.collect()), key=str)
        assert [(a, b, None if c is None else bytes(c)) for a, b, c in got] == \
            [(a, b, None if c is None else bytes(c)) for a, b, c in want]
        assert df.rdd.getNumPartitions() >= (4 if split < 5000 else 3)
    good, _ = P.split_corrupt(P.decode_body(read_avro_capture(spark, f"{scratch}/a")))
    assert _rows(P.parse_messages(good.where("SequenceNumber BETWEEN 0 AND 1000000"))) == \
        _rows(P.parse_messages(X.capture_from_orders(spark, SF001)))


def test_one_file_and_an_empty_folder(spark, scratch, messages):
    write(f"{scratch}/one.avro", messages[:20])
    assert read_avro_capture(spark, f"file://{scratch}/one.avro").count() == 20
    os.makedirs(f"{scratch}/none")
    assert read_avro_capture(spark, f"{scratch}/none").count() == 0
    with pytest.raises(Exception, match="nowhere"):
        read_avro_capture(spark, f"{scratch}/nowhere").count()


def test_broken_files_are_named(spark, scratch, messages):
    write(f"{scratch}/cut/x.avro", messages[:50], cut=30)
    with pytest.raises(Exception, match="cut/x.avro"):
        read_avro_capture(spark, f"{scratch}/cut").count()
    os.makedirs(f"{scratch}/text")
    with open(f"{scratch}/text/y.avro", "w") as f:
        f.write("no Avro at all")
    with pytest.raises(Exception, match="no Avro container file"):
        read_avro_capture(spark, f"{scratch}/text").count()
