"""The stored long weather table: Parquet, one folder per version, location and month.

An upsert writes the months it touches as a new version under new names, then a snapshot that says which version holds
each month, and last a commit file with the next number that names the snapshot. Only this file, which appears at once,
makes the new state visible: readers see the old table or the new one, whatever happens to the writer, and a frame that
was read before keeps its files until `expire`. A store has one writer at a time; a writer that finds another's commit
since it began fails and leaves the table as it is.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.operators.weather import LONG_KEY, TIME, latest_per_key, to_long
from gridwright.session import small_table, written

FOLDERS = ["location_key", "month"]
ROWS = f"{TIME} timestamp, variable string, value double, version string, location_key string, month string"
LIVE = "location_key string, month string, version string"
MAX_BROADCAST_MONTHS = 1_000_000


class StoreChanged(RuntimeError):
    """Another writer has committed since this one looked."""


class _Folder:
    """File operations below the store's path, in whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        context = spark.sparkContext
        self.path, self._jvm = path.rstrip("/"), context._jvm
        self._system = self._at("").getFileSystem(context._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(x.getPath().getName() for x in self._system.listStatus(at)) if self._system.exists(at) else []

    def create(self, name: str) -> None:
        self._system.mkdirs(self._at(name).getParent())
        self._system.createNewFile(self._at(name))

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)


def _commits(folder: _Folder) -> list[tuple[int, str]]:
    """(number, snapshot) of all commits, in order: the file's name is all that a commit says."""
    return sorted((int(n), snapshot) for n, _, snapshot in (name.partition("-") for name in folder.names("commits")) if n.isdigit())


def _live(spark: SparkSession, folder: _Folder) -> tuple[int, DataFrame]:
    """The last commit's number, and which version holds each month of a location."""
    commits = _commits(folder)
    if not commits:
        return 0, small_table(spark, [], LIVE)
    last, snapshot = commits[-1]
    return last, spark.read.schema(LIVE).parquet(f"{folder.path}/snapshots/{snapshot}")


def _rows_of(spark: SparkSession, folder: _Folder, live: DataFrame) -> DataFrame:
    if "data" not in folder.names(""):
        return small_table(spark, [], ROWS)
    small = live.count() <= MAX_BROADCAST_MONTHS
    stored = spark.read.schema(ROWS).parquet(f"{folder.path}/data")
    return stored.join(F.broadcast(live) if small else live, [*FOLDERS, "version"], "left_semi")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last commit; an empty table where nothing has been stored yet."""
    folder = _Folder(spark, path)
    return _rows_of(spark, folder, _live(spark, folder)[1]).select(TIME, "variable", "value", "location_key")


def _commit(folder: _Folder, number: int, snapshot: str) -> None:
    """Make a snapshot the state of the store."""
    if any(n >= number for n, _ in _commits(folder)):
        raise StoreChanged(f"{folder.path} has commit {number} already")
    folder.create(f"commits/{number:012d}-{snapshot}")


def upsert(spark: SparkSession, path: str, batch: DataFrame) -> int:
    """Insert or replace a wide batch (location_key, timestamp_utc, variables); returns its cells.

    The batch is computed once. Only the months of a location that it touches are read, and their merged rows written once.
    """
    folder = _Folder(spark, path)
    number, live = _live(spark, folder)
    month = F.date_format(TIME, "yyyy-MM")
    cells = written(to_long(batch).withColumn(TIME, F.col(TIME).cast("timestamp")).withColumn(
        "value", F.col("value").cast("double")).withColumn("month", month), "cells")
    touched = written(cells.select(*FOLDERS).distinct(), "touched")
    stored = _rows_of(spark, folder, live.join(touched, FOLDERS, "left_semi")).select(*LONG_KEY, "value")
    merged = latest_per_key([stored, cells.select(*LONG_KEY, "value")]).select(*LONG_KEY, "value", month.alias("month"))
    version, snapshot = uuid.uuid4().hex, uuid.uuid4().hex
    merged.hint("rebalance", *[F.col(c) for c in FOLDERS]).write.partitionBy(*FOLDERS).parquet(
        f"{folder.path}/data/version={version}")
    after = live.join(touched, FOLDERS, "left_anti").unionByName(touched.withColumn("version", F.lit(version)))
    after.select(*FOLDERS, "version").write.parquet(f"{folder.path}/snapshots/{snapshot}")
    _commit(folder, number + 1, snapshot)
    return cells.count()


def _value(folder: str) -> str:
    return unquote(folder.partition("=")[2])


def expire(spark: SparkSession, path: str) -> int:
    """Delete what the last commit does not need, the remains of failed writers included; returns the folders deleted. No
    writer may be at work, and frames read before the last commit must not be used any more."""
    folder = _Folder(spark, path)
    commits = _commits(folder)
    if not commits:
        return 0
    _, live = _live(spark, folder)
    current = commits[-1][1]
    needed: dict[str, set[tuple[str, str]]] = {}
    for r in live.toLocalIterator():
        needed.setdefault(r.version, set()).add((r.location_key, r.month))
    gone = []
    for version in folder.names("data"):
        own = needed.get(version.removeprefix("version="))
        if own is None:
            gone += [f"data/{version}"] if version.startswith("version=") else []
            continue
        for place in folder.names(f"data/{version}"):
            for month in folder.names(f"data/{version}/{place}") if "=" in place else ():
                if (_value(place), _value(month)) not in own:
                    gone.append(f"data/{version}/{place}/{month}")
    gone += [f"snapshots/{s}" for s in folder.names("snapshots") if s != current]
    for name in [*gone, *(f"commits/{n:012d}-{s}" for n, s in commits if s != current)]:
        folder.delete(name)
    return len(gone)
