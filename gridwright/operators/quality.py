"""Quality flags: every rule may only raise a row's flag, so all of them form one expression."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridwright.config import BAD, OK, SUSPECT, DemandLimits, SolarLimits, WindLimits
from gridwright.functions.calendars import DST_YEARS, holiday_calendar, is_eu_clock_change
from gridwright.operators.windows import Series, filled, over_series
from gridwright.schemas import SIGNALS

FROZEN_SIGNALS = ("wind_speed_ms", "active_power_kw", "pitch_angle_deg")


@dataclass(frozen=True)
class Rule:
    """Rows where `holds` is true get at least `level`."""

    holds: Column
    level: int

    def score(self) -> Column:
        return F.when(self.holds, self.level).otherwise(OK)


def worst(rules: Iterable[Rule], start: Column | None = None) -> Column:
    scores = [r.score() for r in rules]
    first = F.lit(OK) if start is None else start
    return F.greatest(first, *scores, F.lit(OK)).cast("tinyint")


def raise_flag(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Apply rules on top of the flag the rows already have."""
    return df.withColumn("qc_flag", worst(rules, F.col("qc_flag")))


def keep_ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("qc_flag") == OK)


# wind

def power_range_rules(rated_kw: float, limits: WindLimits = WindLimits()) -> list[Rule]:
    power = F.col("active_power_kw")
    return [Rule(power < 0, BAD), Rule(power > rated_kw * limits.power_tolerance, SUSPECT)]


def wind_range_rules(limits: WindLimits = WindLimits()) -> list[Rule]:
    wind = F.col("wind_speed_ms")
    return [Rule(wind < 0, BAD), Rule(wind > limits.max_wind_ms, SUSPECT)]


def in_maintenance() -> Column:
    return F.when(F.col("status_code") != 0, True).otherwise(F.col("is_maintenance"))


def is_curtailed(rated_kw: float, limits: WindLimits = WindLimits()) -> Column:
    """Strong wind, feathered blades and still little power."""
    held_back = (
        (F.col("wind_speed_ms") > limits.min_curtailed_wind_ms)
        & (F.col("pitch_angle_deg") > limits.min_curtailed_pitch_deg)
        & (F.col("active_power_kw") < rated_kw * limits.curtailed_power_share)
    )
    return F.when(held_back, True).otherwise(F.col("is_curtailed"))


def any_repeat(window: WindowSpec, signals: Iterable[str] = FROZEN_SIGNALS) -> Column:
    """1 where some signal equals its previous reading, else 0."""
    same = [F.coalesce(F.col(s) == F.lag(s).over(window), F.lit(False)) for s in signals]
    out = same[0]
    for s in same[1:]:
        out = out | s
    return out.cast("int")


def frozen_rule(repeat: str, repeats: int, window: WindowSpec) -> Rule:
    """A run of n repeats ends here exactly when the last n rows are all repeats."""
    if repeats <= 0:
        return Rule(F.lit(True), SUSPECT)
    run = F.sum(repeat).over(window.rowsBetween(-(repeats - 1), 0))
    return Rule(run >= repeats, SUSPECT)


def flag_frozen(
    df: DataFrame, series: Series, repeats: int = WindLimits().frozen_repeats, **kw
) -> DataFrame:
    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = d.withColumn("_repeat", any_repeat(w))
        return raise_flag(d, [frozen_rule("_repeat", repeats, w)]).drop("_repeat")

    return over_series(df, series, add, repeats, **kw)


def _fill_after(df: DataFrame, domain: str) -> dict[str, Column]:
    return {c: F.col(f"_fill_{c}") for c in SIGNALS[domain] if c in df.columns}


def _fills(df: DataFrame, domain: str, limit: int, window: WindowSpec) -> dict[str, Column]:
    return {f"_fill_{c}": filled(c, limit, window) for c in SIGNALS[domain] if c in df.columns}


def qc_wind(
    df: DataFrame,
    rated_kw: float,
    limits: WindLimits = WindLimits(),
    series: Series = Series(("turbine_id",)),
    **kw,
) -> DataFrame:
    """All wind rules, judged on the readings as they came; short gaps are filled at the end."""

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        staged = d.withColumns({"_repeat": any_repeat(w), **_fills(d, "wind", limits.fill_rows, w)})
        rules = [
            *power_range_rules(rated_kw, limits),
            *wind_range_rules(limits),
            frozen_rule("_repeat", limits.frozen_repeats, w),
        ]
        flagged = staged.withColumns({
            "qc_flag": worst(rules),
            "is_maintenance": in_maintenance(),
            "is_curtailed": is_curtailed(rated_kw, limits),
        })
        return flagged.withColumns(_fill_after(d, "wind")).select(*d.columns)

    return over_series(df, series, add, max(limits.frozen_repeats, limits.fill_rows), **kw)


# demand

def load_range_rules(limits: DemandLimits = DemandLimits()) -> list[Rule]:
    load = F.col("load_mw")
    return [
        Rule(load < 0, BAD),
        Rule((load < limits.min_load_mw) | (load > limits.max_load_mw), SUSPECT),
    ]


def temperature_rules(limits: DemandLimits = DemandLimits()) -> list[Rule]:
    t = F.col("temperature_c")
    return [Rule((t < limits.min_temperature_c) | (t > limits.max_temperature_c), SUSPECT)]


def demand_wind_rules(limits: DemandLimits = DemandLimits()) -> list[Rule]:
    return [Rule(F.col("wind_speed_ms") > limits.max_wind_ms, SUSPECT)]


def mark_holidays(df: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """`is_holiday` per row's own dataset; datasets without a calendar have none.

    A given `calendar` holds (dataset_id, holiday); the built-in one has some 160 rows.
    """
    given = holiday_calendar(df.sparkSession) if calendar is None else calendar
    # A day may be listed under several names; it still matches a reading once.
    days = given.select(F.col("dataset_id").alias("_ds"), F.col("holiday").alias("_day")).distinct()
    days = F.broadcast(days) if calendar is None else days
    hit = (F.col("dataset_id") == F.col("_ds")) & (F.to_date("timestamp_utc") == F.col("_day"))
    joined = df.join(days, hit, "left")
    return joined.withColumn("is_holiday", F.col("_day").isNotNull()).select(
        *df.columns, *([] if "is_holiday" in df.columns else ["is_holiday"]))


def qc_demand(
    df: DataFrame,
    limits: DemandLimits = DemandLimits(),
    series: Series = Series(("zone_id",)),
    calendar: DataFrame | None = None,
    dst_years: tuple[int, int] | None = DST_YEARS,
    **kw,
) -> DataFrame:
    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        rules = [*load_range_rules(limits), *temperature_rules(limits), *demand_wind_rules(limits)]
        staged = d.withColumns({"qc_flag": worst(rules), **_fills(d, "demand", limits.fill_rows, w)})
        return staged.withColumns(_fill_after(d, "demand")).select(*d.columns)

    marked = mark_holidays(df, calendar).withColumn(
        "is_dst_transition", is_eu_clock_change(F.col("timestamp_utc"), dst_years))
    return over_series(marked, series, add, limits.fill_rows, **kw)


# solar

def night_power_rules(limits: SolarLimits = SolarLimits()) -> list[Rule]:
    return [Rule((F.col("poa_wm2") <= 0) & (F.col("power_kw") > limits.night_power_kw), SUSPECT)]


def pv_power_rules(limits: SolarLimits = SolarLimits()) -> list[Rule]:
    return [Rule(F.col("power_kw") > limits.max_power_kw, SUSPECT)]


def irradiance_rules(limits: SolarLimits = SolarLimits()) -> list[Rule]:
    poa = F.col("poa_wm2")
    return [Rule((poa < limits.min_irradiance_wm2) | (poa > limits.max_irradiance_wm2), SUSPECT)]


def ambient_rules(limits: SolarLimits = SolarLimits()) -> list[Rule]:
    t = F.col("ambient_temp_c")
    return [Rule((t < limits.min_temperature_c) | (t > limits.max_temperature_c), SUSPECT)]


def dead_inverter_rules(limits: SolarLimits = SolarLimits()) -> list[Rule]:
    """Bright sun but no output."""
    return [Rule(
        (F.col("poa_wm2") > limits.bright_irradiance_wm2) & (F.col("power_kw") <= 0), SUSPECT)]


def qc_solar(
    df: DataFrame,
    limits: SolarLimits = SolarLimits(),
    series: Series = Series(("system_id",)),
    **kw,
) -> DataFrame:
    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        rules = [
            *night_power_rules(limits), *pv_power_rules(limits), *irradiance_rules(limits),
            *ambient_rules(limits), *dead_inverter_rules(limits),
        ]
        staged = d.withColumns({"qc_flag": worst(rules), **_fills(d, "solar", limits.fill_rows, w)})
        return staged.withColumns(_fill_after(d, "solar")).select(*d.columns)

    return over_series(df, series, add, limits.fill_rows, **kw)


# summaries

_SUMMARY_EXTRAS = {
    "wind": {"curtailed": "is_curtailed", "maintenance": "is_maintenance"},
    "demand": {"holidays": "is_holiday", "dst_transitions": "is_dst_transition"},
    "solar": {},
}


def qc_summary(df: DataFrame, domain: str, by: Iterable[str] = ()) -> DataFrame:
    """Rows per flag with their share in percent (null for an empty table), in one aggregation."""
    total = F.count("*")
    aggs = [total.alias("total_rows")]
    for name, level in (("ok", OK), ("suspect", SUSPECT), ("bad", BAD)):
        n = F.count_if(F.col("qc_flag") == level)
        share = F.round(100 * n / F.nullif(total, F.lit(0)), 1)
        aggs += [n.alias(f"qc_{name}"), share.alias(f"qc_{name}_pct")]
    aggs += [F.count_if(F.col(c)).alias(a) for a, c in _SUMMARY_EXTRAS[domain].items()]
    return df.groupBy(*by).agg(*aggs)
