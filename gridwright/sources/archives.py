"""ZIP archives, also nested ones, as a source whose partitions are the byte ranges of single members.

The directory at the end of an archive says where each member lies, so planning reads directories only and every task
reads one member, whatever the size of the archive. A nested archive that is stored as it is has its members' ranges in
the outer file; one that is itself compressed is unpacked to the shared folder first, by a task of its own.

An archive or member that cannot be read costs only itself: lines before the damage stay, and `problem` says what was
wrong.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridwright.session import work_path, written
from gridwright.sources.files import files_below, open_input, write_new

LINES_PER_BATCH = 20_000
COPY_BYTES = 4 << 20
READERS = 16
LINES = "archive string, member string, number long, line string, problem string"
UNPACKED = "archive string, prefix string, uri string, problem string"
_DAMAGE = (zipfile.BadZipFile, zlib.error, UnicodeDecodeError, NotImplementedError, RuntimeError, EOFError, OSError)


@dataclass(frozen=True)
class Archive:
    """A file that holds an archive, and what its members are called: they belong to `archive`, below `prefix`."""

    uri: str
    archive: str
    prefix: str = ""


class Member(InputPartition):
    """A member by its place in the file; `info` is its directory entry, or None where `problem` says why there is none."""

    def __init__(self, file: Archive, name: str, at: int = 0, info: zipfile.ZipInfo | None = None, problem: str | None = None):
        super().__init__((file.uri, name))
        self.file, self.name, self.at, self.info, self.problem = file, name, at, info, problem

    @property
    def is_archive(self) -> bool:
        return self.info is not None and self.name.endswith(".zip")


class ByteRange(io.RawIOBase):
    """A part of an open file as a file of its own."""

    def __init__(self, handle, start: int, size: int) -> None:
        self.handle, self.start, self.size, self.place = handle, start, size, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.place = max(0, offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.place, io.SEEK_END: self.size}[whence])
        return self.place

    def readinto(self, buffer) -> int:
        wanted = min(len(buffer), max(0, self.size - self.place))
        self.handle.seek(self.start + self.place)
        got = self.handle.read(wanted)
        buffer[:len(got)] = got
        self.place += len(got)
        return len(got)


def _data_start(handle, at: int) -> int:
    """Where a member's bytes begin, after its local header."""
    handle.seek(at)
    header = handle.read(30)
    if len(header) < 30 or header[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no local header where the directory says")
    return at + 30 + sum(struct.unpack("<HH", header[26:30]))


def members(file: Archive) -> Iterator[Member]:
    """The members of an archive and of archives stored in it, from their directories alone."""
    try:
        with open_input(file.uri) as handle:
            waiting = [(file.prefix, 0, handle.size())]
            while waiting:
                prefix, start, size = waiting.pop()
                for info in zipfile.ZipFile(ByteRange(handle, start, size)).infolist():
                    member = Member(file, prefix + info.filename, start + info.header_offset, info)
                    if member.is_archive and info.compress_type == zipfile.ZIP_STORED:
                        waiting.append((f"{member.name}/", _data_start(handle, member.at), info.compress_size))
                    elif not info.is_dir():
                        yield member
    except _DAMAGE as e:
        yield Member(file, file.prefix, problem=f"{type(e).__name__}: {e}")


def open_member(handle, member: Member) -> zipfile.ZipExtFile:
    """The unpacked bytes of a member, checked against its checksum as they are read."""
    if member.info.flag_bits & 1:
        raise RuntimeError("member is encrypted")
    packed = ByteRange(handle, _data_start(handle, member.at), member.info.compress_size)
    return zipfile.ZipExtFile(packed, "r", member.info)


class _ZipReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.files = [Archive(*x) for x in json.loads(options["archives"])]
        self.wanted = re.compile(options.get("member", ""))
        self.encoding, self.folder = options.get("encoding", "UTF-8"), options.get("folder", "")

    def found(self) -> list[Member]:
        """All members; directories of several archives are read at a time, since each takes a store a while."""
        with ThreadPoolExecutor(READERS) as pool:
            return [m for own in pool.map(lambda file: list(members(file)), self.files) for m in own]


class _LineReader(_ZipReader):
    def partitions(self) -> Sequence[InputPartition]:
        return [
            m for m in self.found()
            if m.problem or (not m.is_archive and self.wanted.search(m.name.rsplit("/", 1)[-1]))]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Member):
            return
        if partition.problem:
            yield self._batch(partition, [(None, None)], partition.problem)
            return
        try:
            with open_input(partition.file.uri) as handle, open_member(handle, partition) as raw:
                lines = enumerate(x.rstrip("\n") for x in io.TextIOWrapper(raw, encoding=self.encoding, newline=None))
                while held := list(islice(lines, LINES_PER_BATCH)):
                    yield self._batch(partition, held, None)
        except _DAMAGE as e:
            yield self._batch(partition, [(None, None)], f"{type(e).__name__}: {e}")

    @staticmethod
    def _batch(member: Member, numbered: Sequence[tuple], problem: str | None) -> pa.RecordBatch:
        count = len(numbered)
        numbers, lines = zip(*numbered)
        return pa.RecordBatch.from_arrays(
            [pa.array([member.file.archive] * count), pa.array([member.name] * count), pa.array(numbers, pa.int64()),
             pa.array(lines, pa.string()), pa.array([problem] * count, pa.string())],
            ["archive", "member", "number", "line", "problem"])


class ZipLines(DataSource):
    """The lines of all members whose base name matches, a partition for each member."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _LineReader(self.options)


class _UnpackReader(_ZipReader):
    def partitions(self) -> Sequence[InputPartition]:
        return [m for m in self.found() if m.is_archive]

    def read(self, partition: Member) -> Iterator[tuple]:
        if not isinstance(partition, Member):
            return
        prefix, archive = f"{partition.name}/", partition.file.archive
        try:
            with open_input(partition.file.uri) as handle, open_member(handle, partition) as raw:
                uri = write_new(self.folder, ".zip", iter(lambda: raw.read(COPY_BYTES), b""))
            yield archive, prefix, uri, None
        except _DAMAGE as e:
            yield archive, prefix, None, f"{type(e).__name__}: {e}"


class ZipUnpacked(DataSource):
    """Compressed nested archives, each written to the shared folder as a file by a task of its own."""

    @classmethod
    def name(cls) -> str:
        return "zip_unpacked"

    def schema(self) -> str:
        return UNPACKED

    def reader(self, schema) -> DataSourceReader:
        return _UnpackReader(self.options)


def _load(spark: SparkSession, source: type[DataSource], files: Iterable[Archive], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    listed = json.dumps([(f.uri, f.archive, f.prefix) for f in files])
    return spark.read.format(source.name()).options(archives=listed, **options).load()


def _all_lines(spark: SparkSession, paths: str | Sequence[str], member_pattern: str, encoding: str, pattern: str) -> DataFrame:
    """Lines and problems of the archives at the paths (files or folders), level by level of compressed nesting."""
    level = [Archive(uri, uri) for p in ([paths] if isinstance(paths, str) else paths) for uri in files_below(p, pattern)]
    files, problems = list(level), []
    while level:
        unpacked = written(_load(spark, ZipUnpacked, level, folder=work_path(spark, "nested")), "unpacked")
        level = [Archive(r.uri, r.archive, r.prefix) for r in unpacked.where("uri is not null").toLocalIterator()]
        files += sorted(level, key=lambda f: (f.archive, f.prefix))
        problems.append(unpacked.where("uri is null").select(
            "archive", F.col("prefix").alias("member"), F.lit(None).cast("long").alias("number"),
            F.lit(None).cast("string").alias("line"), "problem"))
    lines = _load(spark, ZipLines, files, member=member_pattern, encoding=encoding)
    for rows in problems:
        lines = lines.unionByName(rows)
    return lines


def member_lines(
    spark: SparkSession, paths: str | Sequence[str], member_pattern: str, encoding: str = "UTF-8", pattern: str = "*.zip",
) -> DataFrame:
    """(archive, member, number, line) of every member whose base name matches, a partition for each member."""
    return _all_lines(spark, paths, member_pattern, encoding, pattern).where("problem is null").drop("problem")


def archive_problems(
    spark: SparkSession, paths: str | Sequence[str], member_pattern: str, encoding: str = "UTF-8", pattern: str = "*.zip",
) -> DataFrame:
    """(archive, member, problem) of what cannot be read to its end."""
    found = _all_lines(spark, paths, member_pattern, encoding, pattern)
    return found.where("problem is not null").select("archive", "member", "problem")


def write_members(
    spark: SparkSession, paths: str | Sequence[str], out: str, member_pattern: str, encoding: str = "UTF-8", pattern: str = "*.zip",
) -> str:
    """Write the members as UTF-8 text below `out`, one folder per archive and member. A member is one partition, and its
    lines are sorted as the writer wants its folders, so nothing is shuffled and the writer keeps them as they come."""
    lines = member_lines(spark, paths, member_pattern, encoding, pattern)
    ordered = lines.sortWithinPartitions("archive", "member", "number")
    ordered.select("archive", "member", "line").write.partitionBy("archive", "member").text(out)
    return out
