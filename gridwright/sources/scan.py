"""Plain table reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.functions.scalars import number_or_null


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def scan_csv(
    spark: SparkSession,
    path: str,
    null_tokens: Sequence[str] = ("", "NA", "NaN"),
    numbers: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """CSV with a header: text columns with null tokens as null, and lenient doubles for `numbers`."""
    raw = spark.read.options(header="true", **options).csv(path)
    tokens = tuple(null_tokens)
    return raw.select(*[
        (number_or_null(F.col(f"`{c}`"), tokens) if c in numbers
         else F.when(~F.col(f"`{c}`").isin(*tokens), F.col(f"`{c}`"))).alias(c)
        for c in raw.columns
    ])


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """zstd Parquet, one folder per value of `by`.

    Rows keep the partitioning they have: a series may hold a large share of all rows, so they are
    not gathered by it, and AQE's rebalancing splits what is too large for one file.
    """
    df.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by).option(
        "compression", "zstd").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """A CSV folder with a header in each file; metric tables are small and end up in one."""
    df.write.mode("overwrite").option("header", "true").csv(path)
