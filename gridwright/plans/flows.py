"""The three jobs end to end: vendor files to flagged table, to features, to metrics.

Each writes a table and the next reads it, so a later stage never recomputes an earlier one and a
lost executor costs only tasks of the running stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.config import DATASETS, DEFAULT_HORIZONS, DOMAINS
from gridwright.models.direct import (
    Boosting,
    evaluate_horizons,
    predict_horizons,
    targets_table,
    train_horizons,
)
from gridwright.operators.features import (
    complete_rows,
    demand_features,
    feature_set,
    solar_features,
    wind_features,
)
from gridwright.operators.quality import qc_demand, qc_solar, qc_summary, qc_wind
from gridwright.operators.resample import temporal_split
from gridwright.operators.weather import (
    FORECAST_ARCHIVE_START,
    TIME,
    blend,
    clamp_end,
    coverage,
    join_horizons,
    missing_ranges,
    site_weather,
    weather_points,
    weather_site,
)
from gridwright.operators.windows import Series
from gridwright.schemas import schema_errors
from gridwright.session import written
from gridwright.sources.scan import scan_parquet, write_partitioned, write_table
from gridwright.sources.weather_store import read_store, upsert


def flag_table(raw: DataFrame, dataset_id: str, out: str) -> DataFrame:
    """Check the schema, apply the domain's rules, write per series, return the summary."""
    dataset = DATASETS[dataset_id]
    problems = schema_errors(raw, dataset.domain)
    if problems:
        raise ValueError(f"not a canonical {dataset.domain} table: {problems}")
    # Written first: the rules look at the table more than once, and parsing must not repeat.
    raw = written(raw, "raw")
    flagged = {
        "wind": lambda: qc_wind(raw, dataset.rated_power_kw),
        "demand": lambda: qc_demand(raw),
        "solar": lambda: qc_solar(raw),
    }[dataset.domain]()
    write_partitioned(flagged, out, DOMAINS[dataset.domain].series)
    return qc_summary(scan_parquet(raw.sparkSession, out), dataset.domain)


def feature_table(
    flagged: DataFrame, domain: str, level: str, out: str, weather: DataFrame | None = None,
    horizons: Sequence[int] = DEFAULT_HORIZONS,
) -> DataFrame:
    """Features of one level, rows lacking any of them dropped, written as a table."""
    if domain == "wind":
        built = wind_features(flagged, level, weather, horizons)
    elif domain == "demand":
        if level == "full" and weather is not None:
            flagged = join_horizons(flagged, weather, horizons, DOMAINS[domain].step_minutes)
        built = demand_features(flagged, level)
    else:
        built = solar_features(flagged, level)
    write_table(complete_rows(built, domain, f"{domain}_{level}"), out)
    return scan_parquet(flagged.sparkSession, out)


def train_and_evaluate(
    features: DataFrame, domain: str, set_name: str, train_years: int, val_years: int,
    horizons: Sequence[int] = DEFAULT_HORIZONS, settings: Boosting = Boosting(),
) -> DataFrame:
    """Errors per (horizon, split) of one boosted model per horizon, next to persistence."""
    d = DOMAINS[domain]
    names = feature_set(set_name)
    split = temporal_split(features, train_years, val_years)
    table = targets_table(split, Series((d.series,)), d.target, horizons)
    models = train_horizons(table, names, horizons, settings)
    lag1 = d.lag1 if d.lag1 in table.columns else None
    predictions = predict_horizons(models, table, names, keep=[lag1] if lag1 else [])
    return evaluate_horizons(predictions, lag1)


def stored_weather(spark: SparkSession, store: str, site_name: str) -> DataFrame | None:
    """Wide weather of a site from the store; none if no point of it is stored."""
    site = weather_site(site_name)
    long = read_store(spark, store)
    locations = weather_points(spark, [site_name]).select("location_key")
    own = long.join(locations, "location_key", "left_semi")
    return None if own.isEmpty() else site_weather(long, site)


def blended_weather(
    spark: SparkSession, reanalysis: str, forecast: str, site_name: str,
    cutoff: str = FORECAST_ARCHIVE_START, strict: bool = False,
) -> DataFrame | None:
    """Reanalysis before the cutoff and archived forecasts from it on."""
    return blend(
        stored_weather(spark, reanalysis, site_name), stored_weather(spark, forecast, site_name),
        cutoff, strict)


# (location_key, latitude, longitude, first day, last day, variables) -> wide frame with location_key
Fetch = Callable[[str, float, float, date, date, tuple[str, ...]], DataFrame]


def fetched_weather(
    spark: SparkSession, store: str, site_name: str, start: str, end: str, fetch: Fetch
) -> DataFrame:
    """Fetch the day ranges a site's points lack, store them, and return the site's weather.

    The end is clamped to what reanalysis can have. A site has a handful of points, and each lacks at
    most two ranges.
    """
    site = weather_site(site_name)
    points = weather_points(spark, [site_name])
    asked = points.select(
        "location_key", F.lit(start).cast("date").alias("start_date"),
        clamp_end(F.lit(end).cast("date")).alias("end_date"))
    lacking = missing_ranges(asked, coverage(read_store(spark, store)))
    todo = lacking.join(points, "location_key").collect()
    fetched = [
        fetch(r.location_key, r.latitude, r.longitude, r.from_date, r.to_date, site.variables) for r in todo]
    if fetched:
        upsert(spark, store, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fetched))
    last = clamp_end(F.lit(end).cast("date"))
    rows = read_store(spark, store).where(
        (F.col(TIME) >= F.lit(start).cast("date")) & (F.col(TIME) < F.date_add(last, 1)))
    return site_weather(rows, site)
