"""Row windows per series that stay exact when one series is too long for one task.

Every window here looks back (or ahead) a bounded number of rows. That bound is what makes a long
series divisible: it is cut into chunks of consecutive rows, and each chunk also receives the rows
just before it that its first windows reach back to. The copies feed the windows and are dropped
afterwards, so the result equals that of one window over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridwright.session import written

#: A series of more rows is cut; the rows of a window have about a hundred bytes, so this bounds a task's sort near 400 MB.
MAX_SERIES_ROWS = 4_000_000
MAX_BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Series:
    """Columns that identify a series, order it in time, and break ties in time. Ties are numbers."""

    keys: tuple[str, ...]
    time: str = "timestamp_utc"
    ties: tuple[str, ...] = ()

    def order(self, descending: bool = False) -> list[Column]:
        cols = [F.col(c) for c in (self.time, *self.ties)]
        return [c.desc() for c in cols] if descending else [c.asc() for c in cols]


AddColumns = Callable[[DataFrame, WindowSpec], DataFrame]


def over_series(
    df: DataFrame,
    series: Series,
    add: AddColumns,
    reach: int,
    descending: bool = False,
    max_rows: int = MAX_SERIES_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Run `add(frame, window)` where the window is one series in time order.

    `reach` is how many rows back from the current one `add` looks in all (nested windows add up).
    With `descending` the order is reversed, so looking back means looking into the future.
    A count per series decides the plan: one shuffle by series if none exceeds `max_rows`, else
    one shuffle by (series, chunk). Whoever knows a bound passes it as `longest`; filters and
    windows never lengthen a series, so one `longest_series` of the source serves a whole chain.
    """
    if longest is None:
        longest = longest_series(df, series)
    if longest <= max_rows:
        window = Window.partitionBy(*series.keys).orderBy(*series.order(descending))
        return add(df, window)
    chunked = _chunk(df, series, max(max_rows, reach), reach, descending)
    window = Window.partitionBy(*series.keys, "_chunk").orderBy(*series.order(descending))
    return add(chunked, window).where(~F.col("_copy")).drop("_chunk", "_copy")


def longest_series(df: DataFrame, series: Series) -> int:
    """Rows of the longest series."""
    return df.groupBy(*series.keys).count().agg(F.max("count")).first()[0] or 0


def _micros_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("double")


def _distance(series: Series, level: int, start: Column, end: Column) -> Column:
    """How far apart two values of the time (level 0) or of a tie-breaking column are."""
    return _micros_between(start, end) if level == 0 else end.cast("double") - start.cast("double")


def _block_sizes(df: DataFrame, series: Series, by: Sequence[str]) -> DataFrame:
    ends = [f(c).alias(f"{name}{i}") for i, c in enumerate((series.time, *series.ties))
            for f, name in ((F.min, "_first"), (F.max, "_last"))]
    return df.groupBy(*by).agg(F.count("*").alias("_n"), *ends)


def _in_blocks(df: DataFrame, series: Series, rows: int) -> tuple[DataFrame, DataFrame]:
    """Add `_block`, a range of its series in order, and give the table of block sizes.

    A series above `rows` rows is cut into equal time ranges of about rows/4 rows on average. Where
    readings are dense some ranges still hold too many; those are cut again, and by the next
    tie-breaking column where all their rows share one time, until no block is too large. `_block` is
    the path of range numbers, and paths compare in the order of the series. Rows of other series
    have an empty path. Rows that agree in time and all ties have no order and cannot be cut apart.
    """
    keys, columns = list(series.keys), (series.time, *series.ties)
    by = [*keys, "_block"]
    tagged = df.withColumn("_block", F.expr("cast(array() as array<bigint>)"))
    sizes = written(_block_sizes(tagged, series, by).where(F.col("_n") > rows), "blocks")
    while True:
        crowded = sizes.where(F.col("_n") > rows)
        n_crowded = crowded.count()
        if n_crowded == 0:
            return tagged, sizes
        spread = [_distance(series, i, F.col(f"_first{i}"), F.col(f"_last{i}")) for i in range(len(columns))]
        level = F.coalesce(*[F.when(d > 0, F.lit(i)) for i, d in enumerate(spread)])
        width = F.coalesce(*[F.when(d > 0, d) for d in spread]) * rows / (4 * F.col("_n"))
        firsts = [F.col(f"_first{i}") for i in range(len(columns))]
        spans = crowded.select(*by, level.alias("_level"), width.alias("_width"), *firsts)
        if not spans.where(F.col("_level").isNull()).isEmpty():
            raise ValueError(
                f"more than {rows} rows of a series agree in {', '.join(columns)}: name further tie-breaking columns")
        part = F.coalesce(*[
            F.when(F.col("_level") == i, F.floor(_distance(series, i, F.col(f"_first{i}"), F.col(c)) / F.col("_width")))
            for i, c in enumerate(columns)])
        tagged = _null_safe_join(tagged, small_side(spans, n_crowded), by).withColumn(
            "_block",
            F.when(F.col("_width").isNotNull(),
                   F.concat("_block", F.array(F.coalesce(part, F.lit(-1).cast("bigint")))))
            .otherwise(F.col("_block")),
        ).drop("_level", "_width", *[f"_first{i}" for i in range(len(columns))])
        sizes = written(_block_sizes(tagged.where(F.size("_block") > 0), series, by), "blocks")


def _chunk(df: DataFrame, series: Series, rows: int, reach: int, descending: bool) -> DataFrame:
    """Add `_chunk` to the rows of long series, and `_copy` rows for the reach over a chunk's edge.

    The sizes of its blocks give each block its position range in the series; a block belongs to the
    chunk its first position falls in. A block ending at position e is reached from positions below
    e + reach, and as reach <= rows those lie in at most two further chunks.
    """
    keys = list(series.keys)
    tagged, sizes = _in_blocks(df, series, rows)
    order = F.col("_block").desc() if descending else F.col("_block").asc()
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    targets = F.array(
        F.col("_own"), F.floor(F.col("_end") / rows), F.floor((F.col("_end") + (reach - 1)) / rows))
    layout = (
        sizes.withColumn("_end", F.sum("_n").over(before))
        .withColumn("_own", F.floor((F.col("_end") - F.col("_n")) / rows))
        .withColumn("_targets", F.array_distinct(targets) if reach else F.array("_own"))
        .select(*keys, "_block", "_own", "_targets")
    )
    return (
        _null_safe_join(tagged, small_side(layout, sizes.count()), [*keys, "_block"])
        .withColumn("_own", F.coalesce("_own", F.lit(0)))
        .withColumn("_chunk", F.explode(F.coalesce("_targets", F.array("_own"))))
        .withColumn("_copy", F.col("_chunk") != F.col("_own"))
        .drop("_block", "_own", "_targets")
    )


def small_side(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast a side whose counted rows are few; else leave the join to the planner."""
    return F.broadcast(df) if n_rows <= MAX_BROADCAST_ROWS else df


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a null key equals a null key."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(renamed, match, "left").drop(*[f"_r_{c}" for c in on])


def lag_columns(column: str, lags: Sequence[int], window: WindowSpec) -> dict[str, Column]:
    return {f"{column}_lag{k}": F.lag(column, k).over(window) for k in lags}


def rolling_columns(
    column: str, widths: Sequence[int], window: WindowSpec, std_up_to: int
) -> dict[str, Column]:
    """Mean (and sample deviation for short widths) of the rows before this one.

    A value appears only where every row of the frame has one.
    """
    cols = {}
    for width in widths:
        frame = window.rowsBetween(-width, -1)
        full = F.count(column).over(frame) == width
        cols[f"{column}_roll_mean_{width}"] = F.when(full, F.avg(column).over(frame))
        if width <= std_up_to:
            cols[f"{column}_roll_std_{width}"] = F.when(full, F.stddev_samp(column).over(frame))
    return cols


def filled(column: str, limit: int, window: WindowSpec) -> Column:
    """The last value at most `limit` rows back."""
    return F.last(column, ignorenulls=True).over(window.rowsBetween(-limit, 0))


def add_lags(df: DataFrame, series: Series, column: str, lags: Sequence[int], **kw) -> DataFrame:
    return over_series(
        df, series, lambda d, w: d.withColumns(lag_columns(column, lags, w)), max(lags), **kw)


def add_rolling(
    df: DataFrame, series: Series, column: str, widths: Sequence[int], std_up_to: int = 10**9, **kw
) -> DataFrame:
    return over_series(
        df, series, lambda d, w: d.withColumns(rolling_columns(column, widths, w, std_up_to)),
        max(widths), **kw)


def fill_forward(
    df: DataFrame, series: Series, columns: Sequence[str], limit: int, **kw
) -> DataFrame:
    return over_series(
        df, series, lambda d, w: d.withColumns({c: filled(c, limit, w) for c in columns}), limit, **kw)


def add_targets(
    df: DataFrame, series: Series, column: str, horizons: Sequence[int], **kw
) -> DataFrame:
    """`target_h{h}` = the value h rows later in the same series.

    Keys of `series` should name the split too where targets must not cross it.
    """
    return over_series(
        df, series,
        lambda d, w: d.withColumns({f"target_h{h}": F.lag(column, h).over(w) for h in horizons}),
        max(horizons), descending=True, **kw)


def targets_long(
    df: DataFrame, series: Series, column: str, horizons: Sequence[int], **kw
) -> DataFrame:
    """One row per (row, horizon) that has a target: columns `horizon` and `target`."""
    wide = add_targets(df, series, column, horizons, **kw)
    pairs = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"target_h{h}").alias("target")) for h in horizons])
    kept = [c for c in wide.columns if not c.startswith("target_h")]
    return wide.select(*kept, F.inline(pairs)).where(F.col("target").isNotNull())
