"""Full-history map data in the protocol-buffer exchange format, without native libraries. SRC-21.

A file is a chain of compressed blocks. The driver reads only the blocks' sizes
and makes one input partition of each run of blocks, so one file is read by
many tasks; each task decodes its blocks by the wire format's varints.
"""

from __future__ import annotations

import datetime as dt
import struct
import zlib
from collections.abc import Iterator

from almazara.files import opened
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from almazara import schemas

#: Compressed bytes of one input partition.
PARTITION_BYTES = 32 << 20

_ELEMENT = "object_type string, object_id long, version int, visible boolean, timestamp string, changeset long, uid long, user string, longitude double, latitude double, tags array<struct<key:string,value:string>>, nodes array<long>, members array<struct<member_type:string,member_id:long,role:string>>"


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, i
        shift += 7


def _signed(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message; bytes for those with a length."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(data, i)
        elif kind == 2:
            size, i = _varint(data, i)
            value, i = data[i : i + size], i + size
        elif kind == 5:
            value, i = data[i : i + 4], i + 4
        elif kind == 1:
            value, i = data[i : i + 8], i + 8
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield key >> 3, value


def _packed(data: bytes, signed: bool = False) -> list[int]:
    out, i = [], 0
    while i < len(data):
        n, i = _varint(data, i)
        out.append(_signed(n) if signed else n)
    return out


def _running(values: list[int]) -> list[int]:
    total, out = 0, []
    for v in values:
        total += v
        out.append(total)
    return out


def _int64(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def block_offsets(path: str) -> list[tuple[int, int]]:
    """(offset, size) of every data block of a file, from the blocks' headers alone."""
    out = []
    with opened(path) as f:
        while head := f.read(4):
            header = dict(fields(f.read(struct.unpack(">I", head)[0])))
            size = int(header[3])
            if header[1] == b"OSMData":
                out.append((f.tell(), size))
            f.seek(size, 1)
    return out


def elements(block: bytes) -> Iterator[tuple]:
    """Elements of one compressed data block, in the order of the declared columns."""
    blob = dict(fields(block))
    raw = blob[1] if 1 in blob else zlib.decompress(blob[3])
    texts, groups, settings = [], [], {17: 100, 18: 1000, 19: 0, 20: 0}
    for number, value in fields(raw):
        if number == 1:
            texts = [v.decode("utf-8", "replace") for _, v in fields(value)]
        elif number == 2:
            groups.append(value)
        elif number in settings:
            settings[number] = _int64(value)
    degrees = lambda n, offset: 1e-9 * (settings[offset] + settings[17] * n)
    time = lambda n: dt.datetime.fromtimestamp(n * settings[18] / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")

    def info(data: bytes | None) -> tuple:
        got = dict(fields(data)) if data else {}
        return got.get(1, -1), bool(got.get(6, 1)), time(got.get(2, 0)), got.get(3, 0), got.get(4, 0), texts[got.get(5, 0)] if texts else ""

    def plain(data: bytes) -> tuple[dict, list]:
        got = dict(fields(data))
        return got, [(texts[k], texts[v]) for k, v in zip(_packed(got.get(2, b"")), _packed(got.get(3, b"")))]

    for group in groups:
        for number, data in fields(group):
            if number == 1:
                got, tags = plain(data)
                version, visible, *meta = info(got.get(4))
                yield ("node", _signed(got[1]), version, visible, *meta, degrees(_signed(got[9]), 20), degrees(_signed(got[8]), 19), tags, None, None)
            elif number == 2:
                got = dict(fields(data))
                ids, lats, lons = (_running(_packed(got.get(n, b""), True)) for n in (1, 8, 9))
                meta = dict(fields(got[5])) if 5 in got else {}
                versions = _packed(meta.get(1, b"")) or [-1] * len(ids)
                stamps, changes = (_running(_packed(meta.get(n, b""), True)) or [0] * len(ids) for n in (2, 3))
                uids, users = (_running(_packed(meta.get(n, b""), True)) or [0] * len(ids) for n in (4, 5))
                seen = [bool(v) for v in _packed(meta.get(6, b""))] or [True] * len(ids)
                pairs, at = _packed(got.get(10, b"")), 0
                for k, i in enumerate(ids):
                    tags = []
                    while at < len(pairs) and pairs[at]:
                        tags.append((texts[pairs[at]], texts[pairs[at + 1]]))
                        at += 2
                    at += 1
                    # A deleted node has no place.
                    place = (degrees(lons[k], 20), degrees(lats[k], 19)) if seen[k] else (None, None)
                    yield ("node", i, versions[k], seen[k], time(stamps[k]), changes[k], uids[k], texts[users[k]], *place, tags, None, None)
            elif number == 3:
                got, tags = plain(data)
                version, visible, *meta = info(got.get(4))
                yield ("way", _int64(got[1]), version, visible, *meta, None, None, tags, _running(_packed(got.get(8, b""), True)), None)
            elif number == 4:
                got, tags = plain(data)
                version, visible, *meta = info(got.get(4))
                members = zip(_packed(got.get(10, b"")), _running(_packed(got.get(9, b""), True)), _packed(got.get(8, b"")))
                yield ("relation", _int64(got[1]), version, visible, *meta, None, None, tags, None, [("nwr"[kind], i, texts[role]) for kind, i, role in members])


class _Blocks(InputPartition):
    def __init__(self, path: str, blocks: list[tuple[int, int]]) -> None:
        super().__init__((path, tuple(blocks)))


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options["paths"].split("\n") if p]

    def partitions(self):
        out = []
        for path in self.paths:
            run, held = [], 0
            for offset, size in block_offsets(path):
                run.append((offset, size))
                held += size
                if held >= PARTITION_BYTES:
                    out.append(_Blocks(path, run))
                    run, held = [], 0
            if run:
                out.append(_Blocks(path, run))
        return out or [_Blocks("", [])]

    def read(self, partition):
        path, blocks = partition.value
        if not blocks:
            return
        with opened(path) as f:
            for offset, size in blocks:
                f.seek(offset)
                yield from elements(f.read(size))


class MapSource(DataSource):
    """``spark.read.format('almazara_map')``; option: paths (one a line)."""

    @classmethod
    def name(cls) -> str:
        return "almazara_map"

    def schema(self) -> str:
        return _ELEMENT

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every version of every node, way and relation."""
    spark.dataSource.register(MapSource)
    return spark.read.format("almazara_map").option("paths", "\n".join(paths)).load()


def map_tables(elements_: DataFrame) -> dict[str, DataFrame]:
    """Objects, tags, way nodes and relation members. NS-13, SNK-07."""
    key = ["object_type", "object_id", "version"]
    ways, relations = (elements_.where(F.col("object_type") == k) for k in ("way", "relation"))
    tables = {
        "objects": elements_,
        "tags": elements_.select(*key, F.explode("tags").alias("t")).select(*key, "t.key", "t.value"),
        "way_nodes": ways.select(F.col("object_id").alias("way_id"), "version", F.posexplode("nodes").alias("position", "node_id")),
        "relation_members": relations.select(F.col("object_id").alias("relation_id"), "version", F.posexplode("members").alias("position", "m")).select("relation_id", "version", "position", "m.*"),
    }
    return {n: schemas.conform(df, f"osm.{n}") for n, df in tables.items()}
