"""Registration of queries and small helpers to write both sides alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its oracle."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison; adding 0 turns a negative zero into zero."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + 0.0).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def r(expression: str, name: str | None = None, digits: int = 4) -> str:
    """The SQL twin of `rounded` for one column."""
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def rs(columns: Sequence[str], digits: int = 4) -> str:
    return ", ".join(r(c, digits=digits) for c in columns)


def ntz(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz").alias(column)


def without_zone(df: DataFrame) -> DataFrame:
    """Time stamps as SQL TIMESTAMP values."""
    return df.select(*[
        ntz(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])
