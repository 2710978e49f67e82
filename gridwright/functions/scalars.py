"""Column expressions without state: each takes columns and gives a column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Cols = dict[str, Column]


def cyclic(name: str, value: Column, period: float) -> Cols:
    """`{name}_sin` and `{name}_cos` of a value that wraps around after `period`."""
    angle = value.cast("double") * (2 * math.pi / period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def cyclic_hour(ts: Column) -> Cols:
    return cyclic("hour", F.hour(ts), 24)


def cyclic_calendar(ts: Column, with_hour: bool = False) -> Cols:
    """Month of year and ISO day of week (Monday 1 .. Sunday 7), optionally the hour too."""
    cols = {**cyclic("month", F.month(ts), 12), **cyclic("dow", F.weekday(ts) + 1, 7)}
    return {**cyclic_hour(ts), **cols} if with_hour else cols


def cyclic_direction(degrees: Column) -> Cols:
    return cyclic("wind_dir", degrees, 360)


def direction_sector(degrees: Column) -> Column:
    """30-degree sector number, cut toward zero."""
    return (degrees / 30).try_cast("int")


def degree_days(temperature: Column, heat_below: float = 18.0, cool_above: float = 24.0) -> Cols:
    """Degrees below / above the comfort band; a missing temperature counts as none."""
    return {
        "heating_degree_days": F.greatest(F.lit(0.0), heat_below - temperature),
        "cooling_degree_days": F.greatest(F.lit(0.0), temperature - cool_above),
    }


def clearsky_ratio(irradiance: Column, full_sun: float = 1200.0, cap: float = 1.5) -> Column:
    lit_share = F.least(irradiance / full_sun, F.lit(cap))
    return F.when(irradiance > 0, lit_share).otherwise(0.0)


def mean_horizontal(*cols: Column) -> Column:
    """Mean over the columns that have a value in this row."""
    present = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    return total / F.nullif(present, F.lit(0))


def watts_to_kw(watts: Column) -> Column:
    """Kilowatts, never negative; a missing reading becomes 0."""
    return F.greatest(watts / 1000.0, F.lit(0.0))


def kelvin_to_celsius(kelvin: Column) -> Column:
    return kelvin - 273.15


def number_or_null(text: Column, null_tokens: tuple[str, ...] = ()) -> Column:
    """Lenient number: null tokens and anything that is no number become null."""
    trimmed = F.trim(text)
    kept = F.when(~trimmed.isin(*null_tokens), trimmed) if null_tokens else trimmed
    value = kept.try_cast("double")
    return F.when(~F.isnan(value), value)


def status_from_availability(availability: Column) -> Column:
    """1 where the availability is zero; anything else, missing included, is 0."""
    return F.when(availability.try_cast("double") == 0, 1).otherwise(0).cast("int")


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top/bottom with 0/0 and missing as 0 and x/0 as signed infinity."""
    by_zero = (
        F.when(top > 0, F.lit(math.inf)).when(top < 0, F.lit(-math.inf)).otherwise(0.0)
    )
    ratio = F.when(bottom == 0, by_zero).otherwise(F.try_divide(top, bottom))
    return F.when(F.isnan(ratio), 0.0).otherwise(F.coalesce(ratio, F.lit(0.0)))


def horizon_text(steps: Column, step_minutes: int) -> Column:
    """Readable lead time: minutes below an hour, hours below a day, else days."""
    minutes = steps * step_minutes
    hours, days = F.floor(minutes / 60), F.floor(minutes / 1440)
    return (
        F.when(minutes < 60, F.format_string("%d min ahead", minutes.cast("long")))
        .when(minutes < 1440, F.format_string("%dh ahead", hours))
        .otherwise(F.format_string("D+%d", days))
    )


def location_key(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws("_", latitude.cast("string"), longitude.cast("string"))


def parse_utc(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss")


def parse_with_offset(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd HH:mm:ssXXX")


def local_to_utc(local: Column, zone: str, drop_gaps: bool = False) -> Column:
    """Wall-clock time to UTC, for a session in UTC.

    A repeated autumn hour takes the earlier instant. A spring hour that does not exist is moved
    forward, or becomes null with `drop_gaps`.
    """
    utc = F.to_utc_timestamp(local, zone)
    if not drop_gaps:
        return utc
    return F.when(F.from_utc_timestamp(utc, zone) == local.cast("timestamp"), utc)
