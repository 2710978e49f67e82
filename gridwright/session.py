"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


_made: list[str] = []


def local_session(cores: str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine runs."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gridwright")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one is set only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridwright-"))
        current = context.getCheckpointDir()
    return current


def small_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """Configured rows as a local relation: its size is known to the planner and no Python runs for it."""
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in parsed]
    arrow = to_arrow_schema(parsed)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=parsed)


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """The frame as a table in the shared folder: computed once, and its lineage ends there."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete what this driver has written below the shared folder so far, and say how many paths that were.

    Frames read these tables lazily, so this is for the end of a job, when its results are written.
    """
    context = spark.sparkContext
    removed = 0
    while _made:
        path = context._jvm.org.apache.hadoop.fs.Path(_made.pop())
        removed += path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return removed
