"""Buckets, splits and duplicates in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwright.operators.windows import Series, small_side
from gridwright.session import written

TIME = "timestamp_utc"


def bucket(ts: Column, minutes: int) -> Column:
    """Start of the bucket a time falls in; buckets align with midnight and keep the type of ts."""
    into = (F.hour(ts) * 60 + F.minute(ts)) % minutes
    return ts - F.make_dt_interval(mins=into, secs=F.extract(F.lit("SECOND"), ts))


def bucket_mean(
    df: DataFrame, minutes: int, columns: Sequence[str], keys: Sequence[str] = (), time: str = TIME
) -> DataFrame:
    """Mean per bucket, nulls skipped, no rows for empty buckets."""
    start = bucket(F.col(time), minutes).alias(time)
    return df.groupBy(*keys, start).agg(*[F.avg(c).alias(c) for c in columns])


def group_mean(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (TIME,)) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    An aggregation and not a row number, so copies merge before the shuffle however many there are.
    """
    rest = [c for c in df.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(first).select(*key, "_row.*").select(*df.columns)


def split_bounds(df: DataFrame, train_years: int, val_years: int, time: str = TIME) -> tuple[Column, Column]:
    """Start of validation and of test, whole years after the first row (Feb 29 becomes Feb 28)."""
    first = df.agg(F.min(time)).scalar()
    return (
        first + F.make_ym_interval(years=F.lit(train_years)),
        first + F.make_ym_interval(years=F.lit(train_years)) + F.make_ym_interval(years=F.lit(val_years)),
    )


def temporal_split(
    df: DataFrame, train_years: int, val_years: int, time: str = TIME
) -> DataFrame:
    """`split`: train, val or test, half-open in time. The first time stamp is a scalar subquery."""
    val_start, test_start = split_bounds(df, train_years, val_years, time)
    ts = F.col(time)
    return df.withColumn(
        "split", F.when(ts < val_start, "train").when(ts < test_start, "val").when(ts.isNotNull(), "test"))


def split_stats(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))


def with_fold(
    df: DataFrame, series: Series, horizon: int, step_minutes: int, n_windows: int
) -> DataFrame:
    """Adds `fold` and `cutoff`; rows before the first cutoff have fold -1 and no cutoff.

    Folds are counted back from each series' own last row and do not overlap, so a row is tested in
    at most one of them and its fold follows from its distance to the end: no row is copied.
    """
    span = horizon * step_minutes * 60
    ends = written(df.groupBy(*series.keys).agg(F.max(series.time).alias("_end")), "ends")
    ends = small_side(ends, ends.count())
    back = (F.col("_end") - F.col(series.time)).cast("interval second").cast("decimal(20,6)")
    fold = F.greatest(n_windows - 1 - F.floor(back / span), F.lit(-1)).cast("int")
    cutoff = F.col("_end") - F.make_dt_interval(
        secs=((n_windows - F.col("fold")) * span).cast("decimal(18,6)"))
    return (
        df.join(ends, list(series.keys)).withColumn("fold", fold)
        .withColumn("cutoff", F.when(F.col("fold") >= 0, cutoff)).drop("_end")
    )


def rolling_origins(
    df: DataFrame, series: Series, horizon: int, step_minutes: int, n_windows: int
) -> DataFrame:
    """Test rows of each fold: cutoff < time <= cutoff + horizon steps."""
    return with_fold(df, series, horizon, step_minutes, n_windows).where(F.col("fold") >= 0)
