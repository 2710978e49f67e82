"""Feature sets and the builders that produce their columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridwright.config import DOMAINS
from gridwright.functions import scalars as S
from gridwright.operators.quality import keep_ok
from gridwright.operators.weather import join_horizons
from gridwright.operators.windows import Series, lag_columns, over_series, rolling_columns

LEVELS = ("baseline", "enriched", "full")

# The columns each level adds, per domain, with and without target lags.
_HOUR = ["hour_sin", "hour_cos"]
_MONTH_DOW = ["month_sin", "month_cos", "dow_sin", "dow_cos"]
_HOUR_DOW_MONTH = [*_HOUR, "dow_sin", "dow_cos", "month_sin", "month_cos"]
_WIND_SHAPE = ["wind_speed_cubed", "turbulence_intensity", "wind_dir_sector", *_HOUR]
_WIND_NWP = ["nwp_wind_speed_100m", "nwp_wind_direction_100m", "nwp_temperature_2m", *_MONTH_DOW]
_SOLAR_REST = ["ghi_wm2", "wind_speed_ms", *_MONTH_DOW]
_ADDED = {
    "wind": (
        ["wind_speed_ms", "wind_dir_sin", "wind_dir_cos",
         *[f"active_power_kw_lag{k}" for k in (1, 2, 3, 6)],
         *[f"active_power_kw_roll_mean_{w}" for w in (6, 12, 24)], "active_power_kw_roll_std_6"],
        _WIND_SHAPE,
        _WIND_NWP,
    ),
    "demand": (
        [*[f"load_mw_lag{k}" for k in (1, 2, 24, 168)], *_HOUR_DOW_MONTH],
        ["load_mw_roll_mean_24", "load_mw_roll_std_24", "load_mw_roll_mean_168", "is_holiday"],
        ["nwp_temperature_2m", "nwp_wind_speed_10m", "nwp_relative_humidity_2m",
         "heating_degree_days", "cooling_degree_days"],
    ),
    "solar": (
        ["poa_wm2", *[f"power_kw_lag{k}" for k in (1, 2, 4, 8, 96)], *_HOUR],
        ["clearsky_ratio", "ambient_temp_c", "module_temp_c",
         *[f"power_kw_roll_mean_{w}" for w in (4, 16, 96)], "power_kw_roll_std_4"],
        _SOLAR_REST,
    ),
    "wind_exog": (["wind_speed_ms", "wind_dir_sin", "wind_dir_cos"], _WIND_SHAPE, _WIND_NWP),
    "demand_exog": (
        _HOUR_DOW_MONTH,
        ["temperature_c", "heating_degree_days", "cooling_degree_days"],
        ["wind_speed_ms", "humidity_pct", "price_eur_mwh", "price_lag1", "price_lag24", "is_holiday"],
    ),
    "solar_exog": (
        ["poa_wm2", *_HOUR], ["clearsky_ratio", "ambient_temp_c", "module_temp_c"], _SOLAR_REST),
}

FEATURE_SETS: dict[str, list[str]] = {
    f"{family}_{level}": [c for part in parts[: i + 1] for c in part]
    for family, parts in _ADDED.items()
    for i, level in enumerate(LEVELS)
}


def feature_set(name: str) -> list[str]:
    if name not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {name!r}; known: {', '.join(sorted(FEATURE_SETS))}")
    return FEATURE_SETS[name]


def list_feature_sets() -> list[str]:
    return list(FEATURE_SETS)


def select_feature_set(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """`keep` plus the columns of the set; columns the frame lacks are left out."""
    return df.select(*keep, *[c for c in feature_set(name) if c in df.columns and c not in keep])


def turbulence(window: WindowSpec, wind: str = "wind_speed_ms", rows: int = 6) -> Column:
    """Deviation of the wind over the preceding rows relative to the wind now."""
    deviation = rolling_columns(wind, [rows], window, rows)[f"{wind}_roll_std_{rows}"]
    return S.guarded_ratio(deviation, F.col(wind))


def wind_shape(window: WindowSpec) -> dict[str, Column]:
    return {
        "wind_speed_cubed": F.pow("wind_speed_ms", F.lit(3.0)),
        "turbulence_intensity": turbulence(window),
        "wind_dir_sector": S.direction_sector(F.col("wind_direction_deg")),
    }


def price_lags(window: WindowSpec, column: str = "price_eur_mwh") -> dict[str, Column]:
    return {f"price_lag{k}": F.lag(column, k).over(window) for k in (1, 24)}


def _numeric_holiday(df: DataFrame) -> dict[str, Column]:
    return {"is_holiday": F.col("is_holiday").cast("tinyint")} if "is_holiday" in df.columns else {}


def _degree_source(df: DataFrame) -> dict[str, Column]:
    """Forecast temperature at the shortest horizon, else the observed one."""
    for name in ("nwp_temperature_2m_h1", "temperature_c"):
        if name in df.columns:
            return S.degree_days(F.col(name))
    return {}


def _series(domain: str, series: Series | None) -> Series:
    return series or Series((DOMAINS[domain].series,))


def _rank(level: str) -> int:
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    return LEVELS.index(level)


def wind_features(
    df: DataFrame,
    level: str = "baseline",
    weather: DataFrame | None = None,
    horizons: Sequence[int] | None = None,
    series: Series | None = None,
    lags: bool = True,
    step_minutes: int = 10,
    **kw,
) -> DataFrame:
    """Good rows with wind features; `lags=False` gives the exogenous-only variant."""
    rank, domain = _rank(level), DOMAINS["wind"]
    ts = F.col("timestamp_utc")

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        cols = S.cyclic_direction(F.col("wind_direction_deg"))
        if lags:
            cols |= lag_columns(domain.target, domain.lags, w)
            cols |= rolling_columns(domain.target, domain.windows, w, domain.std_up_to)
        if rank >= 1:
            cols |= {**wind_shape(w), **S.cyclic_hour(ts)}
        if rank >= 2:
            cols |= S.cyclic_calendar(ts)
        return d.withColumns(cols)

    reach = max(domain.lags) if lags else 6
    out = over_series(keep_ok(df), _series("wind", series), add, reach, **kw)
    if rank >= 2 and lags and weather is not None and horizons:
        out = join_horizons(out, weather, horizons, step_minutes)
    return out


def demand_features(
    df: DataFrame, level: str = "baseline", series: Series | None = None, lags: bool = True, **kw
) -> DataFrame:
    """Good rows with load features. For `full`, join the weather horizons first."""
    rank, domain = _rank(level), DOMAINS["demand"]

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        cols = S.cyclic_calendar(F.col("timestamp_utc"), with_hour=True)
        if lags:
            cols |= lag_columns(domain.target, domain.lags, w)
            if rank >= 1:
                cols |= rolling_columns(domain.target, domain.windows, w, domain.std_up_to)
                cols |= _numeric_holiday(d)
            if rank >= 2:
                cols |= _degree_source(d)
        else:
            if rank >= 1:
                cols |= S.degree_days(F.col("temperature_c"))
            if rank >= 2:
                cols |= {**price_lags(w), **_numeric_holiday(d)}
        return d.withColumns(cols)

    reach = max(domain.lags) if lags else 24
    return over_series(keep_ok(df), _series("demand", series), add, reach, **kw)


def solar_features(
    df: DataFrame, level: str = "baseline", series: Series | None = None, lags: bool = True, **kw
) -> DataFrame:
    rank, domain = _rank(level), DOMAINS["solar"]
    ts = F.col("timestamp_utc")

    def scalar(d: DataFrame) -> dict[str, Column]:
        cols = S.cyclic_hour(ts)
        if rank >= 1:
            cols["clearsky_ratio"] = S.clearsky_ratio(F.col("poa_wm2"))
        if rank >= 2:
            cols |= S.cyclic_calendar(ts)
        return cols

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        cols = {**scalar(d), **lag_columns(domain.target, domain.lags, w)}
        if rank >= 1:
            cols |= rolling_columns(domain.target, domain.windows, w, domain.std_up_to)
        return d.withColumns(cols)

    good = keep_ok(df)
    if not lags:
        return good.withColumns(scalar(good))
    return over_series(good, _series("solar", series), add, max(domain.lags), **kw)


def lag_transforms(df: DataFrame, domain: str, series: Series, column: str = "y", **kw) -> DataFrame:
    """Lags and rolling mean and deviation of the target, every window of the domain with both."""
    d = DOMAINS[domain]

    def add(frame: DataFrame, w: WindowSpec) -> DataFrame:
        return frame.withColumns(
            {**lag_columns(column, d.lags, w), **rolling_columns(column, d.windows, w, max(d.windows))})

    return over_series(df, series, add, max(*d.lags, *d.windows), **kw)


def complete_rows(df: DataFrame, domain: str, set_name: str) -> DataFrame:
    """Drop rows lacking the target or any column of the set, forecast variants included.

    Columns the frame does not have are not required.
    """
    required = [DOMAINS[domain].target]
    for name in feature_set(set_name):
        if name.startswith("nwp_"):
            required += [c for c in df.columns if c.startswith(name)]
        elif name in df.columns:
            required.append(name)
    return df.dropna(subset=list(dict.fromkeys(required)))


# Raw columns a long forecast frame leaves out.
RAW_COLUMNS = (
    "qc_flag", "status_code", "raw_active_power_kw", "raw_wind_speed", "raw_wind_direction",
    "pitch_angle_avg_deg", "nacelle_direction_deg", "rotor_speed_rpm", "ambient_temp_c_raw",
    "generator_speed_rpm", "generator_bearing_temp_c", "yaw_error_deg", "blade_pitch_std_deg",
)


def long_forecast_frame(df: DataFrame, domain: str) -> DataFrame:
    """(unique_id, ds, y) plus the remaining feature columns."""
    d = DOMAINS[domain]
    return (
        df.drop(*RAW_COLUMNS)
        .withColumnsRenamed({d.series: "unique_id", "timestamp_utc": "ds", d.target: "y"})
        .withColumn("unique_id", F.col("unique_id").cast("string"))
    )


def horizon_columns(available: Sequence[str], wanted: Sequence[str], horizon: int) -> dict[str, str]:
    """Source column for each wanted name at one horizon; unavailable names are left out.

    A forecast column `nwp_x` is read from `nwp_x_h{horizon}` where that exists.
    """
    have, chosen = set(available), {}
    for name in wanted:
        candidates = [f"{name}_h{horizon}", name] if name.startswith("nwp_") else [name]
        source = next((c for c in candidates if c in have), None)
        if source:
            chosen[name] = source
    return chosen


def select_horizon(
    df: DataFrame, wanted: Sequence[str], horizon: int, keep: Sequence[str] = ()
) -> DataFrame:
    chosen = horizon_columns(df.columns, wanted, horizon)
    return df.select(*keep, *[F.col(src).alias(name) for name, src in chosen.items()])
