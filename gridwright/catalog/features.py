"""Feature pipelines: three domains, three levels, with and without target lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.joins import nwp_sql
from gridwright.catalog.quality import (
    AMBIENT_SCORE,
    DEMAND_AND_HOLIDAYS,
    DEMAND_WIND_SCORE,
    INVERTER_SCORE,
    IRRADIANCE_SCORE,
    IS_HOLIDAY,
    LOAD_SCORE,
    NIGHT_SCORE,
    POWER_SCORE,
    PV_SCORE,
    TEMPERATURE_SCORE,
    WIND_SCORE,
)
from gridwright.catalog.registry import query, r, rounded, rs, table
from gridwright.catalog.tables import _cyc
from gridwright.catalog.time import DEMAND_W, SOLAR_W, TURBULENCE, WIND_W, lag_sql, roll_sql, upsample_body
from gridwright.config import DEFAULT_HORIZONS
from gridwright.operators import features as FT
from gridwright.operators import quality as Q
from gridwright.operators import weather as WX
from gridwright.operators import windows as W
from gridwright.operators.resample import bucket

HORIZONS = list(DEFAULT_HORIZONS)
HOUR = _cyc("hour", "hour(timestamp_utc) * 2 * pi() / 24")
CALENDAR = (_cyc("month", "month(timestamp_utc) * 2 * pi() / 12") + ", "
            + _cyc("dow", "isodow(timestamp_utc) * 2 * pi() / 7"))
DIRECTION = _cyc("wind_dir", "wind_direction_deg * pi() / 180")
SHAPE = f"""{r('wind_speed_ms * wind_speed_ms * wind_speed_ms', 'wind_speed_cubed', 2)},
  {r(TURBULENCE, 'turbulence_intensity')}, CAST(trunc(wind_direction_deg / 30) AS INTEGER) AS wind_dir_sector"""

WIND_GOOD = V.also(V.SCADA, good=f"SELECT * FROM scada WHERE greatest({POWER_SCORE}, {WIND_SCORE}) = 0")
DEMAND_GOOD = V.also(DEMAND_AND_HOLIDAYS, good=f"""
  SELECT q.* EXCLUDE (is_holiday), CAST({IS_HOLIDAY} AS TINYINT) AS is_holiday FROM demand AS q
  WHERE greatest({LOAD_SCORE}, {TEMPERATURE_SCORE}, {DEMAND_WIND_SCORE}) = 0""")
SOLAR_GOOD = V.also(V.SOLAR_SQL, good=f"""SELECT * FROM solar
  WHERE greatest({NIGHT_SCORE}, {PV_SCORE}, {IRRADIANCE_SCORE}, {AMBIENT_SCORE}, {INVERTER_SCORE}) = 0""")


def _flagged_wind(spark, sf):
    rules = [*Q.power_range_rules(V.RATED_KW), *Q.wind_range_rules()]
    return Q.raise_flag(V.scada(spark, sf), rules)


def _flagged_demand(spark, sf):
    rules = [*Q.load_range_rules(), *Q.temperature_rules(), *Q.demand_wind_rules()]
    return Q.raise_flag(Q.mark_holidays(V.demand(spark, sf)), rules)


def _flagged_solar(spark, sf):
    rules = [*Q.night_power_rules(), *Q.pv_power_rules(), *Q.irradiance_rules(), *Q.ambient_rules(),
             *Q.dead_inverter_rules()]
    return Q.raise_flag(V.solar(spark, sf), rules)


def _tidy(df, key, base, cube=False):
    """The key and the columns the builder added."""
    out = df.drop(*[c for c in base.columns if c not in (key, "is_holiday")])
    if "is_holiday" in out.columns and dict(out.dtypes)["is_holiday"] == "boolean":
        out = out.drop("is_holiday")
    if cube:
        coarse = F.round("wind_speed_cubed", 2) + 0.0
        return rounded(out.withColumn("wind_speed_cubed", coarse))
    return rounded(out)


_wind_lags = f"{lag_sql('active_power_kw', (1, 2, 3, 6, 12, 24), WIND_W)}, {roll_sql('active_power_kw', (6, 12, 24), WIND_W)}"
WIND_LEVELS = {
    "baseline": f"{_wind_lags}, {DIRECTION}",
    "enriched": f"{_wind_lags}, {DIRECTION}, {SHAPE}, {HOUR}",
}
# The weather join matches whole ten-minute marks, so the full set runs on readings moved to them.
MARKED = "SELECT * REPLACE (time_bucket(INTERVAL 10 MINUTE, timestamp_utc) AS timestamp_utc) FROM scada"


def _on_marks(df):
    return df.withColumn("timestamp_utc", bucket(F.col("timestamp_utc"), 10))


for _level, _columns in WIND_LEVELS.items():
    @query(f"wind_features_{_level}", WIND_GOOD + f"SELECT event_id, {_columns} FROM good")
    def _wind(spark, sf, level=_level):
        base = _flagged_wind(spark, sf)
        return _tidy(FT.wind_features(base, level, series=V.WIND), "event_id", base, level != "baseline")


NWP = ["wind_speed_100m", "wind_direction_100m", "temperature_2m"]


@query("wind_features_full", V.also(
    V.also(V.WEATHER, scada=V.SCADA_BODY), marked=MARKED, fine=upsample_body("weather_wide"),
    good=f"SELECT * FROM marked WHERE greatest({POWER_SCORE}, {WIND_SCORE}) = 0",
    built=f"SELECT event_id, timestamp_utc, {WIND_LEVELS['enriched']}, {CALENDAR} FROM good")
    + nwp_sql("built", "fine", HORIZONS, NWP, 10, "o.* EXCLUDE (timestamp_utc)"))
def wind_features_full(spark, sf):
    base = _on_marks(_flagged_wind(spark, sf))
    weather = V.weather_wide(spark, sf).select("timestamp_utc", *NWP)
    return _tidy(FT.wind_features(base, "full", weather, HORIZONS, V.WIND), "event_id", base, True)


_demand_lags = lag_sql("load_mw", (1, 2, 24, 168), DEMAND_W)
_demand_rolls = roll_sql("load_mw", (24, 168), DEMAND_W, 24)


def _degrees(source: str) -> str:
    return (r(f"greatest(0.0, 18.0 - {source})", "heating_degree_days") + ", "
            + r(f"greatest(0.0, {source} - 24.0)", "cooling_degree_days"))


DEMAND_LEVELS = {
    "baseline": f"{_demand_lags}, {HOUR}, {CALENDAR}",
    "enriched": f"{_demand_lags}, {HOUR}, {CALENDAR}, {_demand_rolls}, is_holiday",
}
for _level, _columns in DEMAND_LEVELS.items():
    @query(f"demand_features_{_level}", DEMAND_GOOD + f"SELECT o_orderkey, {_columns} FROM good")
    def _demand(spark, sf, level=_level):
        base = _flagged_demand(spark, sf)
        return _tidy(FT.demand_features(base, level, V.DEMAND), "o_orderkey", base)


LOAD_WEATHER = ("temperature_2m", "wind_speed_10m", "relative_humidity_2m")
# Hourly weather for the years of the orders: the price level of the other orders of that hour.
LOAD_WEATHER_BODY = """SELECT o_orderdate + INTERVAL '20' YEAR + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS timestamp_utc,
  avg(o_totalprice / 4903.7 - 30) AS temperature_2m, avg(o_totalprice / 9803.7) AS wind_speed_10m,
  avg(o_totalprice / 5003.7) AS relative_humidity_2m FROM orders GROUP BY 1"""


@query("demand_features_full", V.also(DEMAND_GOOD, load_weather=LOAD_WEATHER_BODY, joined=f"""
  SELECT g.*, w1.temperature_2m AS t1, {', '.join(f'w{h}.{v} AS nwp_{v}_h{h}' for h in HORIZONS for v in LOAD_WEATHER)}
  FROM good g """ + " ".join(
    f"LEFT JOIN load_weather w{h} ON w{h}.timestamp_utc = g.timestamp_utc + {h} * INTERVAL 1 HOUR" for h in HORIZONS))
    + f"""SELECT o_orderkey, {DEMAND_LEVELS['enriched']}, {_degrees('t1')},
  {rs([f'nwp_{v}_h{h}' for h in HORIZONS for v in LOAD_WEATHER])} FROM joined""")
def demand_features_full(spark, sf):
    weather = spark.sql(LOAD_WEATHER_BODY.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))
    base = _flagged_demand(spark, sf)
    joined = WX.join_horizons(base, weather, HORIZONS, 60)
    return _tidy(FT.demand_features(joined, "full", V.DEMAND), "o_orderkey", base)


_solar_lags = lag_sql("power_kw", (1, 2, 4, 8, 96), SOLAR_W)
_solar_rolls = roll_sql("power_kw", (4, 16, 96), SOLAR_W, 4)
CLEAR = r("CASE WHEN poa_wm2 > 0 THEN least(poa_wm2 / 1200.0, 1.5) ELSE 0.0 END", "clearsky_ratio")
SOLAR_LEVELS = {
    "baseline": f"{_solar_lags}, {HOUR}",
    "enriched": f"{_solar_lags}, {HOUR}, {CLEAR}, {_solar_rolls}",
    "full": f"{_solar_lags}, {HOUR}, {CLEAR}, {_solar_rolls}, {CALENDAR}",
}
for _level, _columns in SOLAR_LEVELS.items():
    @query(f"solar_features_{_level}", SOLAR_GOOD + f"SELECT event_id, {_columns} FROM good")
    def _solar(spark, sf, level=_level):
        base = _flagged_solar(spark, sf)
        return _tidy(FT.solar_features(base, level, V.SOLAR), "event_id", base)


# without target lags

WIND_EXOG = {"baseline": DIRECTION, "enriched": f"{DIRECTION}, {SHAPE}, {HOUR}",
             "full": f"{DIRECTION}, {SHAPE}, {HOUR}, {CALENDAR}"}
for _level, _columns in WIND_EXOG.items():
    @query(f"wind_exog_{_level}", WIND_GOOD + f"SELECT event_id, {_columns} FROM good")
    def _wind_exog(spark, sf, level=_level):
        base = _flagged_wind(spark, sf)
        out = FT.wind_features(base, level, series=V.WIND, lags=False)
        return _tidy(out, "event_id", base, level != "baseline")

_prices = (r(f"lag(price_eur_mwh, 1) OVER ({DEMAND_W})", "price_lag1") + ", "
           + r(f"lag(price_eur_mwh, 24) OVER ({DEMAND_W})", "price_lag24"))
DEMAND_EXOG = {"baseline": f"{HOUR}, {CALENDAR}", "enriched": f"{HOUR}, {CALENDAR}, {_degrees('temperature_c')}",
               "full": f"{HOUR}, {CALENDAR}, {_degrees('temperature_c')}, {_prices}, is_holiday"}
for _level, _columns in DEMAND_EXOG.items():
    @query(f"demand_exog_{_level}", DEMAND_GOOD + f"SELECT o_orderkey, {_columns} FROM good")
    def _demand_exog(spark, sf, level=_level):
        base = _flagged_demand(spark, sf)
        return _tidy(FT.demand_features(base, level, V.DEMAND, lags=False), "o_orderkey", base)

SOLAR_EXOG = {"baseline": HOUR, "enriched": f"{HOUR}, {CLEAR}", "full": f"{HOUR}, {CLEAR}, {CALENDAR}"}
for _level, _columns in SOLAR_EXOG.items():
    @query(f"solar_exog_{_level}", SOLAR_GOOD + f"SELECT event_id, {_columns} FROM good")
    def _solar_exog(spark, sf, level=_level):
        base = _flagged_solar(spark, sf)
        return _tidy(FT.solar_features(base, level, V.SOLAR, lags=False), "event_id", base)


@query("lag_transform_features", V.SOLAR_SQL + f"""SELECT unique_id, ds, {r('y')}, {lag_sql('y', (1, 2, 4, 8, 96), 'PARTITION BY unique_id ORDER BY ds')},
  {roll_sql('y', (4, 16, 96), 'PARTITION BY unique_id ORDER BY ds')}
FROM (SELECT system_id AS unique_id, timestamp_utc AS ds, power_kw AS y FROM solar) AS t""")
def lag_transform_features(spark, sf):
    frame = FT.long_forecast_frame(V.solar(spark, sf), "solar").select("unique_id", "ds", "y")
    return rounded(FT.lag_transforms(frame, "solar", W.Series(("unique_id",), "ds")))
