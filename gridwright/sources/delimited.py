"""Folders of delimited files whose headers may differ from file to file, read in one scan.

A task reads the first bytes of each file and notes at which place of a line each wanted column stands. These notes are a
small table, one row per file, that is joined to the lines by file: a line carries its file's layout as data, so one plan
covers all layouts, and neither the files' names nor their headers come to the driver. Nothing but the lines is scanned.

What cannot be read costs only itself: a file without its header or a needed column, and a line that is no text in the
encoding, are left out and listed among the rejects. A file without any bytes is neither read nor listed.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.session import written
from gridwright.sources.files import open_input

MAX_BROADCAST_FILES = 100_000
#: A header is looked for in so many bytes at the beginning of a file.
HEAD_BYTES = 1 << 18


@dataclass(frozen=True)
class Format:
    """`header` is a pattern that the header line matches; lines that begin with `comment` are no rows."""

    header: str
    separator: str = ","
    encoding: str = "UTF-8"
    comment: str | None = None


@dataclass(frozen=True)
class Delimited:
    """Lines in columns; `files` is a written table with a row per file, usable ones without a fault."""

    rows: DataFrame
    rejects: DataFrame
    files: DataFrame
    n_files: int
    n_usable: int


def _names(line: str, separator: str) -> list[str]:
    return [name.strip().strip('"') for name in line.split(separator)]


def _fault(names: Sequence[str], needed: Sequence[str], any_of: Sequence[str]) -> str | None:
    lacking = [c for c in needed if c not in names]
    if lacking:
        return f"no column {', '.join(lacking)}"
    return None if not any_of or set(any_of) & set(names) else f"none of the columns {', '.join(any_of)}"


def layouts(
    spark: SparkSession, path: str, columns: Mapping[str, str], fmt: Format, pattern: str = "*", wanted: str = "",
    needed: Sequence[str] = (), any_of: Sequence[str] = (),
) -> DataFrame:
    """(file, file_no, header, places, fault) of the files whose path matches `wanted`: file numbers follow the paths,
    places are those of the columns in a line, counted from 1, 0 for a column the file does not have."""
    header, sources = re.compile(fmt.header), list(columns)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_header_of(uri, header, fmt.encoding) for uri in batch.column("file").to_pylist()]
            places, faults = [], []
            for line, fault in found:
                names = _names(line, fmt.separator) if line is not None else []
                places.append([names.index(c) + 1 if c in names else 0 for c in sources])
                faults.append(fault or _fault(names, needed, any_of))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), pa.array([line for line, _ in found], pa.string()),
                 pa.array(places, pa.list_(pa.int32())), pa.array(faults, pa.string())], ["file", "header", "places", "fault"])

    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
        .select(F.col("_metadata.file_path").alias("file")).where(F.col("file").rlike(wanted)))
    heads = listed.mapInArrow(look, "file string, header string, places array<int>, fault string")
    # Numbers grow along a sorted table, partition after partition.
    return written(heads.sort("file").withColumn("file_no", F.monotonically_increasing_id()), "layouts")


def _header_of(uri: str, header: re.Pattern, encoding: str) -> tuple[str | None, str | None]:
    """The header line of a file, or what is wrong with the file."""
    try:
        with open_input(uri) as handle:
            head = handle.read(HEAD_BYTES)
    except OSError as e:
        return None, f"unreadable: {e}"
    text = io.StringIO(head.decode(encoding, errors="replace").removeprefix("\ufeff"), newline=None)
    line = next((line.rstrip("\n") for line in text if header.search(line)), None)
    return line, None if line is not None else "no header"


def _fields(line: Column, separator: str) -> Column:
    """The fields of a line; a field in quotes may hold separators, and two quotes there stand for one."""
    split = re.escape(separator)
    taken = F.regexp_extract_all(line, F.lit(f'("(?:[^"]|"")*"|[^{split}]*)(?:{split}|$)'), F.lit(1))
    quoted = F.transform(taken, lambda x: F.when(
        x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(F.instr(line, '"') > 0, quoted).otherwise(F.split(line, split))


def read_delimited(
    spark: SparkSession, path: str, columns: Mapping[str, str], fmt: Format, pattern: str = "*", wanted: str = "",
    needed: Sequence[str] = (), any_of: Sequence[str] = (),
) -> Delimited:
    """Text columns of all files below a path, named by `columns`, with `file_no` and `position` (rows of a file in order)
    and `places`. A field that is empty or missing is null. `needed` names headers that a file must have all of, `any_of`
    ones that it must have one of; files that do not match `wanted` are not looked at."""
    files = layouts(spark, path, columns, fmt, pattern, wanted, needed, any_of)
    count, n_usable = files.agg(F.count("*"), F.count_if(F.col("fault").isNull())).first()
    notes = files.select("file", "file_no", "header", "places", "fault")
    raw = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
    # Within one block of a file, rows keep their order in one task; blocks order by their start.
    position = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    utf8 = fmt.encoding.upper().replace("_", "-") in ("UTF-8", "UTF8")
    line = F.try_validate_utf8("value") if utf8 else F.decode(F.col("value").cast("binary"), fmt.encoding)
    lines = raw.select(F.col("_metadata.file_path").alias("file"), position.alias("position"), "value", line.alias("line"))
    joined = lines.join(F.broadcast(notes) if count <= MAX_BROADCAST_FILES else notes, "file")
    no_row = F.coalesce(F.ltrim(F.col("line"), F.lit("\ufeff")) == F.col("header"), F.lit(False)) | F.coalesce(F.col("line") == "", F.lit(False))
    if fmt.comment:
        no_row = no_row | F.coalesce(F.col("line").startswith(fmt.comment), F.lit(False))
    body = joined.where(F.col("fault").isNull() & ~no_row)
    parsed = body.where(F.col("line").isNotNull()).select(
        "file_no", "position", "places", _fields(F.col("line"), fmt.separator).alias("fields"))
    chosen = [
        F.nullif(F.when(F.col("places")[k] > 0, F.get("fields", F.col("places")[k] - 1)), F.lit("")).alias(target)
        for k, target in enumerate(columns.values())]
    rows = parsed.select("file_no", "position", "places", *chosen)
    bad_lines = body.where(F.col("line").isNull()).select(
        "file", F.hex(F.col("value").cast("binary")).alias("bytes"), F.lit(f"no {fmt.encoding} text").alias("reason"))
    bad_files = files.where("fault is not null").select("file", F.lit(None).cast("string").alias("bytes"), F.col("fault").alias("reason"))
    return Delimited(rows, bad_files.unionByName(bad_lines), files, count, n_usable)


def has(columns: Mapping[str, str], target: str) -> Column:
    """Whether the row's file has the column of that name."""
    return F.col("places")[list(columns.values()).index(target)] > 0


def with_file_peak(df: DataFrame, column: str, by: str = "file", n_files: int | None = None) -> DataFrame:
    """Adds `_peak`, the largest value of the column in the row's file.

    Maxima are aggregated per file and joined back, so a huge file is never one group. They are
    broadcast where the number of files, given or counted in the written maxima, is small.
    """
    peaks = df.groupBy(by).agg(F.max(column).alias("_peak"))
    if n_files is None:
        peaks = written(peaks, "peaks")
        n_files = peaks.count()
    if n_files <= MAX_BROADCAST_FILES:
        peaks = F.broadcast(peaks)
    return df.join(peaks, by, "left")


def usable(read: Delimited, path: str, what: str) -> Delimited:
    """The same, if any file could be read."""
    if not read.n_usable:
        raise FileNotFoundError(f"no {what} below {path}")
    return read
