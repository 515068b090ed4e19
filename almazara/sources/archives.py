"""Members of archives as tables: one partition per archive, nothing extracted to disk.

The data source ``almazara_lines`` gives the lines of zip, tar, gzip, bzip2 and plain
files with their physical line numbers; ``member_texts`` gives whole members. An
archive is not splittable, so its partition is the unit of parallelism, and a
lost task simply reads its archive again.
"""

from __future__ import annotations

import bz2
import gzip
import io
import tarfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from almazara.files import opened, size_of

#: Bytes of lines in one Arrow batch.
BATCH_BYTES = 1 << 20


def open_members(path: str, suffix: str = "") -> Iterator[tuple[str, io.BufferedIOBase]]:
    """(member name, byte stream) of the members of an archive whose name ends in ``suffix``."""
    low = path.lower()
    if low.endswith(".zip"):
        with opened(path) as file, zipfile.ZipFile(file) as archive:
            for info in archive.infolist():
                if not info.is_dir() and info.filename.lower().endswith(suffix.lower()):
                    with archive.open(info) as stream:
                        yield info.filename, stream
    elif low.endswith((".tar", ".tar.gz", ".tgz", ".tar.bz2")):
        with opened(path) as file, tarfile.open(fileobj=file, mode="r|*") as archive:
            for info in archive:
                if info.isfile() and info.name.lower().endswith(suffix.lower()):
                    yield info.name, archive.extractfile(info)
    else:
        unpacked = gzip.open if low.endswith(".gz") else bz2.open if low.endswith(".bz2") else lambda file, _: file
        with opened(path) as file, unpacked(file, "rb") as stream:
            yield path.rsplit("/", 1)[-1], stream


class _Archive(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


class _LinesReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options["paths"].split("\n") if p]
        self.suffix = options.get("suffix", "")
        self.encoding = options.get("encoding", "utf-8")
        self.errors = options.get("errors", "strict")

    def partitions(self):
        return [_Archive(p) for p in self.paths]

    def read(self, partition):
        """Arrow batches of lines; strict UTF-8 is checked by Arrow, other decoding is done line by line."""
        import pyarrow as pa

        plain = self.encoding.lower().replace("_", "-") == "utf-8" and self.errors == "strict"
        for member, stream in open_members(partition.path, self.suffix):
            number = 0
            while lines := stream.readlines(BATCH_BYTES):
                cut = [line.rstrip(b"\r\n") for line in lines]
                values = pa.array(cut, pa.binary()).cast(pa.string()) if plain else pa.array([line.decode(self.encoding, self.errors) for line in cut], pa.string())
                n = len(cut)
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * n), pa.array([member] * n), pa.array(range(number + 1, number + n + 1), pa.int64()), values], names=["archive", "member", "line_number", "value"])
                number += n


class LinesSource(DataSource):
    """``spark.read.format('almazara_lines')``; options: paths (one a line), suffix, encoding, errors."""

    @classmethod
    def name(cls) -> str:
        return "almazara_lines"

    def schema(self) -> str:
        return "archive string, member string, line_number long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _LinesReader(self.options)


def archive_lines(spark: SparkSession, paths: list[str], *, suffix: str = "", encoding: str = "utf-8", errors: str = "strict") -> DataFrame:
    """(archive, member, line_number, value): lines in physical order within a member. SRC-01, SRC-05, SRC-10."""
    spark.dataSource.register(LinesSource)
    return spark.read.format("almazara_lines").options(paths="\n".join(paths), suffix=suffix, encoding=encoding, errors=errors).load()


def member_texts(spark: SparkSession, paths: list[str], *, suffix: str = "", encoding: str = "utf-8", errors: str = "strict") -> DataFrame:
    """(archive, member, text): whole members; for documents of a bounded size."""
    names = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(max(1, len(paths)))

    def run(frames):
        import pandas as pd

        for frame in frames:
            for path in frame["archive"]:
                for member, stream in open_members(path, suffix):
                    yield pd.DataFrame({"archive": [path], "member": [member], "text": [stream.read().decode(encoding, errors)]})

    return names.mapInPandas(run, "archive string, member string, text string")


def member_elements(spark: SparkSession, paths: list[str], names: list[str], *, suffix: str = "") -> DataFrame:
    """(archive, member, text): the elements of these names of XML members, one a row, each in a root of its own.

    Members are parsed as they are unpacked and elements let go once they are given
    on, so a member of any size takes the memory of one element. A member without
    such an element gives no row.
    """
    archives_ = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(max(1, len(paths)))

    def run(frames):
        import xml.etree.ElementTree as ET

        import pandas as pd

        for frame in frames:
            for path in frame["archive"]:
                for member, stream in open_members(path, suffix):
                    rows, root, depth, inside = [], None, 0, 0
                    for event, element in ET.iterparse(stream, events=("start", "end")):
                        wanted = element.tag.rsplit("}", 1)[-1] in names
                        if event == "start":
                            root = element if root is None else root
                            depth, inside = depth + 1, inside + wanted
                            continue
                        depth, inside = depth - 1, inside - wanted
                        # The outermost of nested elements is given on whole.
                        if wanted and not inside:
                            element.tail = None
                            rows.append((path, member, f"<root>{ET.tostring(element, encoding='unicode')}</root>"))
                            element.clear()
                        if not inside and depth == 1:
                            root.clear()
                        if len(rows) >= 500:
                            yield pd.DataFrame(rows, columns=["archive", "member", "text"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["archive", "member", "text"])

    return archives_.mapInPandas(run, "archive string, member string, text string")


def is_sound_archive(path: str, size: int | None = None, md5: str | None = None) -> bool:
    """Whether an archive has its size and MD5 and its members read back whole. DQ-12."""
    import hashlib

    found = size_of(path)
    if found is None or (size is not None and found != size):
        return False
    if md5 is not None:
        digest = hashlib.md5()
        with opened(path) as f:
            for block in iter(lambda: f.read(1 << 20), b""):
                digest.update(block)
        if digest.hexdigest() != md5.lower():
            return False
    if path.lower().endswith(".zip"):
        try:
            with opened(path) as file, zipfile.ZipFile(file) as archive:
                return archive.testzip() is None and bool(archive.namelist())
        except zipfile.BadZipFile:
            return False
    return True


def manifest_sizes(lines: DataFrame) -> DataFrame:
    """(name, bytes) of a size manifest: a number and a file name a line. SRC-27."""
    parts = F.split(F.trim("value"), r"\s+")
    return lines.where(F.trim("value").rlike(r"^\d+\s+\S+$")).select(parts[1].alias("name"), parts[0].cast("long").alias("bytes"))


def manifest_checksums(lines: DataFrame) -> DataFrame:
    """(name, md5) of a checksum manifest; other lines are left out. SRC-27, FN-19."""
    parts = F.split(F.trim("value"), r"\s+")
    return lines.where(F.trim("value").rlike(r"^[0-9a-fA-F]{32}\s+\*?\S+$")).select(F.regexp_replace(parts[1], r"^\*", "").alias("name"), F.lower(parts[0]).alias("md5"))
