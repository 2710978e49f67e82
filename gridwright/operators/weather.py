"""Weather tables: wide (one column per variable), long (stored), and their joins to observations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwright.functions.scalars import location_key
from gridwright.operators.windows import small_side
from gridwright.session import small_table, written

TIME = "timestamp_utc"
LONG_KEY = ("location_key", TIME, "variable")
REANALYSIS_DELAY_DAYS = 5
FORECAST_ARCHIVE_START = "2022-01-01"
MAX_BROADCAST_BYTES = 200_000_000
KEY_BYTES = 64


@dataclass(frozen=True)
class WeatherSite:
    """Weather variables for one site, as a weighted mean over one or more points."""

    name: str
    variables: tuple[str, ...]
    points: tuple[tuple[str, float, float, float], ...] = field(default=())

    def __post_init__(self) -> None:
        total = sum(p[3] for p in self.points)
        if self.points and abs(total - 1.0) > 0.01 + 1e-9:
            raise ValueError(f"weights of {self.name} must sum to 1, got {total:.4f}")


# Variables, coordinates and weights per site.
WEATHER_SITES = {
    s.name: s
    for s in (
        WeatherSite(
            "kelmarsh",
            ("wind_speed_100m", "wind_direction_100m", "wind_speed_10m", "wind_direction_10m",
             "temperature_2m", "pressure_msl"),
            (("kelmarsh", 52.4016, -0.9436, 1.0),)),
        WeatherSite(
            "spain_demand", ("temperature_2m", "wind_speed_10m", "relative_humidity_2m"),
            (("madrid", 40.4168, -3.7038, 1.0),)),
        WeatherSite(
            "rte_france",
            ("temperature_2m", "wind_speed_10m", "relative_humidity_2m", "shortwave_radiation"),
            (("idf_paris", 48.86, 2.35, 0.30), ("cvl_tours", 47.40, 0.70, 0.14),
             ("aura_lyon", 45.76, 4.84, 0.15), ("hdf_lille", 50.63, 3.06, 0.10),
             ("naq_bordeaux", 44.84, -0.58, 0.08), ("occ_toulouse", 43.60, 1.44, 0.08),
             ("paca_marseille", 43.30, 5.37, 0.07), ("gest_strasbourg", 48.58, 7.75, 0.08))),
        WeatherSite(
            "pvdaq_system4",
            ("shortwave_radiation", "temperature_2m", "wind_speed_10m", "cloud_cover"),
            (("golden", 39.7407, -105.1686, 1.0),)),
    )
}


def weather_site(name: str) -> WeatherSite:
    if name not in WEATHER_SITES:
        raise ValueError(f"unknown weather site {name!r}; known: {', '.join(sorted(WEATHER_SITES))}")
    return WEATHER_SITES[name]


def weather_points(spark: SparkSession, sites: Sequence[str] | None = None) -> DataFrame:
    """(site, point, location_key, weight): a few rows per configured site, so joins broadcast it."""
    rows = [
        (site.name, *point)
        for name in (sites or WEATHER_SITES)
        for site in [weather_site(name)]
        for point in site.points
    ]
    table = small_table(
        spark, rows, "site string, point string, latitude double, longitude double, weight double")
    return F.broadcast(
        table.withColumn("location_key", location_key(F.col("latitude"), F.col("longitude"))))


def variables_of(wide: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in wide.columns if c not in keys]


# long <-> wide

def to_long(wide: DataFrame, keys: Sequence[str] = ("location_key", TIME)) -> DataFrame:
    return wide.unpivot(list(keys), variables_of(wide, keys), "variable", "value")


def to_wide(
    long: DataFrame, variables: Sequence[str], keys: Sequence[str] = (TIME,)
) -> DataFrame:
    """One column per listed variable; (keys, variable) is unique, so max is that value.

    Conditional maxima take one aggregation where a pivot takes two.
    """
    return long.groupBy(*keys).agg(*cells("variable", variables))


def cells(name: str, wanted: Sequence[str], value: str = "value") -> list[Column]:
    return [F.max(F.when(F.col(name) == w, F.col(value))).alias(w) for w in wanted]


def latest_per_key(
    batches: Sequence[DataFrame], key: Sequence[str] = LONG_KEY, value: str = "value"
) -> DataFrame:
    """Union of batches in arrival order; the last one to write a key wins, nulls included."""
    numbered = [
        b.select(*key, value, F.lit(i).alias("_batch")) for i, b in enumerate(batches)]
    rows = reduce(DataFrame.unionByName, numbered)
    return rows.groupBy(*key).agg(F.max_by(value, "_batch").alias(value))


def query_long(
    long: DataFrame, location: str, start: str, end: str, variables: Sequence[str]
) -> DataFrame:
    """Wide hourly table of one location from the start day to the end day, that day included."""
    ts = F.col(TIME)
    rows = long.where(
        (F.col("location_key") == location)
        & (ts >= F.lit(start).cast("date"))
        & (ts < F.date_add(F.lit(end).cast("date"), 1))
        & F.col("variable").isin(*variables)
    )
    return to_wide(rows, variables)


def coverage(long: DataFrame) -> DataFrame:
    return long.groupBy("location_key").agg(
        F.min(TIME).alias("first_ts"), F.max(TIME).alias("last_ts"))


def missing_ranges(requested: DataFrame, covered: DataFrame) -> DataFrame:
    """Day ranges still to fetch before and after what is stored; holes inside are not looked for.

    `requested` has (location_key, start_date, end_date) with date columns. A range shares its
    boundary day with the stored data, so that day is fetched again.
    """
    first, last = F.to_date("first_ts"), F.to_date("last_ts")
    start, end = F.col("start_date"), F.col("end_date")

    def span(part: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), a.alias("from_date"), b.alias("to_date"))

    ranges = F.when(F.col("first_ts").isNull(), F.array(span("all", start, end))).otherwise(
        F.filter(
            F.array(
                F.when(start < first, span("before", start, first)),
                F.when(end > last, span("after", last, end)),
            ),
            lambda r: r.isNotNull(),
        ))
    joined = requested.join(covered, "location_key", "left")
    return joined.select("location_key", F.inline(ranges))


def clamp_end(end: Column, today: Column | None = None) -> Column:
    """Reanalysis lags behind: no later than five days before today."""
    return F.least(end, F.date_sub(F.current_date() if today is None else today, REANALYSIS_DELAY_DAYS))


def require_forecast_start(start: Column) -> Column:
    """The start date, failing the job where it lies before the forecast archive begins."""
    first = F.lit(FORECAST_ARCHIVE_START).cast("date")
    problem = F.concat(F.lit("forecast archive starts 2022-01-01; asked for "), start.cast("string"))
    return F.when(start >= first, start).otherwise(F.raise_error(problem).cast("date"))


# combining

def weighted_mean(
    long: DataFrame, points: DataFrame, keys: Sequence[str] = (TIME, "variable")
) -> DataFrame:
    """Mean over points; weights are renormalised over the points that have a value.

    `points` holds (location_key, weight), one row per configured point: a counted small table is
    broadcast, so that the long one is not shuffled by its few locations.
    """
    weighted = long.join(small_side(points.select("location_key", "weight"), points.count()), "location_key")
    used = F.sum(F.when(F.col("value").isNotNull(), F.col("weight")))
    total = F.sum(F.col("weight") * F.col("value"))
    return weighted.groupBy(*keys).agg(F.try_divide(total, used).alias("value"))


def site_weather(long: DataFrame, site: WeatherSite) -> DataFrame:
    """Wide weather of one site from the stored long table."""
    points = weather_points(long.sparkSession, [site.name])
    rows = long.where(F.col("variable").isin(*site.variables))
    return to_wide(weighted_mean(rows, points), site.variables)


def blend(
    before: DataFrame | None, after: DataFrame | None, cutoff: str, strict: bool = False
) -> DataFrame | None:
    """`before` up to the cutoff and `after` from it on, over their common columns.

    If one source is absent the other is returned whole; `strict` refuses that.
    """
    if before is None or after is None:
        if strict:
            raise ValueError("both weather sources are needed to blend at a cutoff")
        return before if after is None else after
    limit = F.lit(cutoff).cast("timestamp_ntz").cast(before.schema[TIME].dataType)
    common = [c for c in before.columns if c in after.columns]
    return before.where(F.col(TIME) < limit).select(*common).unionByName(
        after.where(F.col(TIME) >= limit).select(*common))


def hourly_grid(df: DataFrame) -> DataFrame:
    """Responses (start, end, step_seconds, values array) to one row per step, end excluded."""
    step = F.make_dt_interval(secs=F.col("step_seconds").cast("decimal(18,6)"))
    times = F.sequence(F.col("start"), F.col("end") - step, step)
    kept = [c for c in df.columns if c not in ("start", "end", "step_seconds", "values")]
    zipped = F.arrays_zip(times.alias("timestamp_utc"), F.col("values").alias("value"))
    return df.select(*kept, F.inline(zipped))


# aligning with observations

def upsample(
    wide: DataFrame, step_minutes: int, source_minutes: int = 60, keys: Sequence[str] = (), bounds: tuple | None = None,
) -> DataFrame:
    """Forward-filled grid from the first to the last source time at the finer step. Who knows these times passes them as
    `bounds`, where there are no keys.

    Each source row is filled from its predecessors and then repeated up to the next source row, so
    the windows run over the few source rows and not over the grid. They run month by month; a
    summary row per month carries the last values, and the start of the next month, across the edge.
    Source rows off the grid do not take part. A step as coarse as the source changes nothing.
    """
    if step_minutes >= source_minutes:
        return wide
    values = variables_of(wide, [*keys, TIME])
    step = F.expr(f"interval '{step_minutes}' minute")
    ends = [F.min(TIME).alias("_first"), F.max(TIME).alias("_last")]
    if keys:
        bounded = wide.join(wide.groupBy(*keys).agg(*ends), list(keys))
    else:
        first, last = bounds or wide.agg(*ends).first()
        if first is None:
            return wide
        kind = wide.schema[TIME].dataType
        bounded = wide.withColumns(
            {"_first": F.lit(first).cast(kind), "_last": F.lit(last).cast(kind)})
    seconds = (F.col(TIME) - F.col("_first")).cast("interval second").cast("decimal(20,6)")
    source = bounded.where(seconds % (step_minutes * 60) == 0).withColumn(
        "_month", F.trunc(TIME, "month"))

    block = [*keys, "_month"]
    across = Window.partitionBy(*keys).orderBy("_month")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    summary = source.groupBy(*block).agg(
        F.min(TIME).alias("_start"),
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(TIME))).alias(f"_last_{v}") for v in values],
    ).select(
        *block, F.lead("_start").over(across).alias("_next"),
        *[F.last(f"_last_{v}", ignorenulls=True).over(earlier).alias(f"_carry_{v}") for v in values])

    within = Window.partitionBy(*block).orderBy(TIME)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    filled = source.withColumns({
        **{v: F.last(v, ignorenulls=True).over(so_far) for v in values},
        "_following": F.lead(TIME).over(within),
    }).join(summary, block)
    until = F.coalesce(F.coalesce("_following", "_next") - step, F.col("_last"))
    grid = F.when(until > F.col(TIME), F.sequence(F.col(TIME), until, step)).otherwise(F.array(TIME))
    return filled.select(
        *keys, F.explode(grid).alias("_grid"),
        *[F.coalesce(v, f"_carry_{v}").alias(v) for v in values],
    ).select(*keys, F.col("_grid").alias(TIME), *values)


def horizons_table(
    wide: DataFrame,
    horizons: Sequence[int],
    step_minutes: int,
    variables: Sequence[str] | None = None,
    prefix: str = "nwp_",
    keys: Sequence[str] = (),
    bounds: tuple | None = None,
) -> DataFrame:
    """Weather as seen from each observation time: `{prefix}{variable}_h{h}` is its value h steps on."""
    names = list(variables or variables_of(wide, [*keys, TIME]))
    grid = upsample(wide.select(*keys, TIME, *names), step_minutes, keys=keys, bounds=bounds)
    shifted = grid.select(
        *keys, *names,
        F.inline(F.array(*[
            F.struct(
                F.lit(h).alias("_h"),
                (F.col(TIME) - F.expr(f"interval '{h * step_minutes}' minute")).alias(TIME))
            for h in horizons
        ])))
    columns = [
        F.max(F.when(F.col("_h") == h, F.col(v))).alias(f"{prefix}{v}_h{h}")
        for h in horizons for v in names
    ]
    return shifted.groupBy(*keys, TIME).agg(*columns)


def join_horizons(
    df: DataFrame,
    wide: DataFrame,
    horizons: Sequence[int],
    step_minutes: int,
    variables: Sequence[str] | None = None,
    prefix: str = "nwp_",
    keys: Sequence[str] = (),
) -> DataFrame:
    """One left join for all horizons.

    The weather is written once, so its source is evaluated once; its first and last times, read off the written table, say
    how large the joined table can be. It is broadcast if that is small enough, and the observations then need no shuffle.
    Else the planner decides.
    """
    names = list(variables or variables_of(wide, [*keys, TIME]))
    if not names:
        return df
    stored = written(wide.select(*keys, TIME, *names), "weather")
    rows, bounds = most_rows(stored, horizons, step_minutes, keys)
    table = horizons_table(stored, horizons, step_minutes, names, prefix, keys, bounds)
    row_bytes = 8 * (len(names) * len(horizons) + 2) + KEY_BYTES * len(keys)
    if rows * row_bytes <= MAX_BROADCAST_BYTES:
        table = F.broadcast(table)
    return df.join(table, [*keys, TIME], "left")


def most_rows(
    wide: DataFrame, horizons: Sequence[int], step_minutes: int, keys: Sequence[str] = (),
    source_minutes: int = 60,
) -> tuple[int, tuple | None]:
    """No fewer rows than the horizons table can have, and the first and last time where there are no keys."""
    seconds = (F.max(TIME) - F.min(TIME)).cast("interval second").cast("decimal(20,6)")
    spans = wide.groupBy(*keys).agg(
        (seconds / (60 * step_minutes)).alias("steps"), F.count("*").alias("n"), F.min(TIME).alias("a"), F.max(TIME).alias("b"))
    steps, n, first, last = spans.agg(
        F.sum(F.col("steps") + max(horizons) + 2), F.sum("n"), F.min("a"), F.max("b")).first()
    rows = int(n or 0) * len(horizons) if step_minutes >= source_minutes else int(steps or 0)
    return rows, None if keys else (first, last)
