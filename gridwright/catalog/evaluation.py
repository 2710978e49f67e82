"""Forecast errors, regimes and metric tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.quality import qc_wind_sql
from gridwright.catalog.registry import query, r, rounded
from gridwright.catalog.time import DEMAND_SPLIT, SOLAR_W, WIND_W, demand_split
from gridwright.config import DEFAULT_HORIZONS
from gridwright.models.recursive import persistence_folds
from gridwright.operators import features as FT
from gridwright.operators import metrics as M
from gridwright.operators import quality as Q
from gridwright.operators import windows as W
from gridwright.operators.metric_states import QuantileOf, merged_metrics, pinball

HORIZONS = list(DEFAULT_HORIZONS)


def errors_sql(y: str, yhat: str) -> str:
    return f"""{r(f'avg(abs({yhat} - {y}))', 'mae')}, {r(f'sqrt(avg(({yhat} - {y}) * ({yhat} - {y})))', 'rmse')},
  {r(f'avg({yhat} - {y})', 'bias')}"""


def mape_sql(y: str, yhat: str) -> str:
    return r(f"CASE WHEN count(*) FILTER (WHERE {y} = 0) = 0 THEN avg(abs(({yhat} - {y}) / {y})) END", "mape")


# A forecast next to each load: the operator's, with the previous load as persistence.
PAIRS = """SELECT o_orderkey, split, zone_id, timestamp_utc, load_mw AS y, tso_forecast_mw AS yhat,
  lag(load_mw) OVER (PARTITION BY zone_id ORDER BY timestamp_utc, o_orderkey) AS last_y FROM parts"""
COMPLETE = "SELECT * FROM paired WHERE y IS NOT NULL AND yhat IS NOT NULL AND last_y IS NOT NULL"
PAIRED = V.also(DEMAND_SPLIT, paired=PAIRS, pairs=COMPLETE)


def _pairs(spark, sf):
    frame = demand_split(spark, sf).select(
        "o_orderkey", "split", "zone_id", "timestamp_utc", "load_mw", F.col("tso_forecast_mw").alias("yhat"))
    lagged = W.add_lags(frame, V.DEMAND, "load_mw", [1])
    return lagged.withColumnsRenamed({"load_mw": "y", "load_mw_lag1": "last_y"}).dropna(
        subset=["y", "yhat", "last_y"])


@query("regression_metrics", PAIRED + f"""SELECT split, zone_id, {errors_sql('y', 'yhat')}, {mape_sql('y', 'yhat')}
FROM pairs GROUP BY 1, 2""")
def regression_metrics(spark, sf):
    return rounded(M.regression_metrics(_pairs(spark, sf), "y", "yhat", ["split", "zone_id"]))


@query("skill_score", PAIRED + f"""SELECT split, {r('''CASE WHEN avg((last_y - y) * (last_y - y)) = 0
  THEN CASE WHEN avg((yhat - y) * (yhat - y)) = 0 THEN 1.0 ELSE '-infinity'::DOUBLE END
  ELSE 1 - sqrt(avg((yhat - y) * (yhat - y))) / sqrt(avg((last_y - y) * (last_y - y))) END''', 'skill_score')}
FROM pairs GROUP BY 1""")
def skill_score(spark, sf):
    score = M.skill_score(F.col("y"), F.col("yhat"), F.col("last_y"))
    return rounded(M.summarise(_pairs(spark, sf), ["split"], {"skill_score": score}))


FLAGGED_WIND = V.also(V.SCADA, flagged=qc_wind_sql(final=False), good="SELECT * FROM flagged WHERE qc_flag = 0")
WIND_TARGETS = "\nUNION ALL ".join(
    f"""SELECT {h} AS horizon, wind_speed_ms, active_power_kw, lag(active_power_kw) OVER w AS last_y,
  lead(active_power_kw, {h}) OVER w AS target FROM good WINDOW w AS ({WIND_W})""" for h in HORIZONS)


@query("persistence_metrics", V.also(FLAGGED_WIND, targets=WIND_TARGETS) + f"""SELECT horizon, count(*) AS n_rows,
  {r('avg(abs(last_y - target))', 'persistence_mae')}, {r('sqrt(avg((last_y - target) * (last_y - target)))', 'persistence_rmse')},
  {r('avg(last_y - target)', 'persistence_bias')} FROM targets WHERE target IS NOT NULL GROUP BY 1""")
def persistence_metrics(spark, sf):
    readings = V.scada(spark, sf)
    longest = W.longest_series(readings, V.WIND)
    flagged = Q.qc_wind(readings, V.RATED_KW, series=V.WIND, longest=longest)
    featured = FT.wind_features(flagged, "baseline", series=V.WIND, longest=longest)
    targets = W.targets_long(featured, V.WIND, "active_power_kw", HORIZONS, longest=longest)
    cols = {"n_rows": F.count("*"), **M.persistence_columns("target", "active_power_kw_lag1")}
    return rounded(M.summarise(targets, ["horizon"], cols))


@query("persistence_forecast", V.SOLAR_SQL + f"SELECT event_id, {r(f'lag(power_kw) OVER ({SOLAR_W})', 'prediction')} FROM solar")
def persistence_forecast(spark, sf):
    frame = V.solar(spark, sf).select("event_id", "system_id", "timestamp_utc", "power_kw")
    lagged = W.add_lags(frame, V.SOLAR, "power_kw", [1])
    return rounded(lagged.select("event_id", F.col("power_kw_lag1").alias("prediction")))


def _regime(y: str, yhat: str, regime: str, source: str) -> str:
    return f"""SELECT regime, {r(f'avg(abs({yhat} - {y}))', 'mae')},
  {r(f'sqrt(avg(({yhat} - {y}) * ({yhat} - {y})))', 'rmse')}, count(*) AS n_samples
FROM (SELECT *, {regime} AS regime FROM {source}) AS t WHERE regime IS NOT NULL GROUP BY 1"""


WIND_PAIRS = f"""SELECT wind_speed_ms, active_power_kw AS y, lag(active_power_kw) OVER ({WIND_W}) AS yhat FROM scada"""


@query("regime_wind", V.also(V.SCADA, pairs=f"SELECT * FROM ({WIND_PAIRS}) AS p WHERE y IS NOT NULL AND yhat IS NOT NULL")
       + _regime("y", "yhat", """CASE WHEN wind_speed_ms < 5 THEN 'low' WHEN wind_speed_ms <= 12 THEN 'medium'
         WHEN wind_speed_ms > 12 THEN 'high' END""", "pairs"))
def regime_wind(spark, sf):
    frame = V.scada(spark, sf).select(
        "event_id", "turbine_id", "timestamp_utc", "wind_speed_ms", "active_power_kw")
    pairs = W.add_lags(frame, V.WIND, "active_power_kw", [1]).dropna(
        subset=["active_power_kw", "active_power_kw_lag1"])
    return rounded(M.regime_metrics(
        pairs, "active_power_kw", "active_power_kw_lag1", M.wind_regime(F.col("wind_speed_ms"))))


@query("regime_demand", PAIRED + _regime("y", "yhat", """CASE WHEN hour(timestamp_utc) < 8 THEN 'off_peak'
  WHEN hour(timestamp_utc) < 18 THEN 'shoulder' ELSE 'peak' END""", "pairs"))
def regime_demand(spark, sf):
    return rounded(M.regime_metrics(_pairs(spark, sf), "y", "yhat", M.demand_regime(F.col("timestamp_utc"))))


SOLAR_PAIRS = f"""SELECT poa_wm2, power_kw AS y, lag(power_kw) OVER ({SOLAR_W}) AS yhat FROM solar"""


@query("regime_solar", V.also(V.SOLAR_SQL, pairs=f"SELECT * FROM ({SOLAR_PAIRS}) AS p WHERE y IS NOT NULL AND yhat IS NOT NULL")
       + _regime("y", "yhat", """CASE WHEN poa_wm2 >= 0 AND poa_wm2 < 200 THEN 'low_irradiance'
         WHEN poa_wm2 >= 200 AND poa_wm2 < 600 THEN 'medium_irradiance' WHEN poa_wm2 >= 600 THEN 'high_irradiance' END""",
                 "pairs"))
def regime_solar(spark, sf):
    frame = V.solar(spark, sf).select("event_id", "system_id", "timestamp_utc", "poa_wm2", "power_kw")
    pairs = W.add_lags(frame, V.SOLAR, "power_kw", [1]).dropna(subset=["power_kw", "power_kw_lag1"])
    return rounded(M.regime_metrics(pairs, "power_kw", "power_kw_lag1", M.solar_regime(F.col("poa_wm2"))))


@query("tso_baseline_metrics", DEMAND_SPLIT + f"""SELECT split, {errors_sql('load_mw', 'tso_forecast_mw')},
  {mape_sql('load_mw', 'tso_forecast_mw')} FROM parts WHERE split <> 'train' AND load_mw IS NOT NULL
  AND tso_forecast_mw IS NOT NULL GROUP BY 1""")
def tso_baseline_metrics(spark, sf):
    return rounded(M.tso_baseline(demand_split(spark, sf)))


def _capped_loss(actual: pd.Series, predicted: pd.Series) -> pd.Series:
    return (predicted - actual).abs().clip(upper=1000.0)


@query("custom_metrics", PAIRED + f"""SELECT split, {r('max(abs(yhat - y))', 'worst')},
  {r('sum(abs(yhat - y)) / sum(abs(y))', 'wape')}, {r('avg(least(abs(yhat - y), 1000.0))', 'capped')} FROM pairs GROUP BY 1""")
def custom_metrics(spark, sf):
    pairs = _pairs(spark, sf)
    built_in = M.custom_metrics(pairs, "y", "yhat", {
        "worst": lambda y, p: F.max(F.abs(p - y)),
        "wape": lambda y, p: F.sum(F.abs(p - y)) / F.sum(F.abs(y)),
    }, ["split"])
    plain = M.custom_metrics_additive(pairs, "y", "yhat", {"capped": _capped_loss}, ["split"])
    return rounded(built_in.join(plain, "split"))


@query("custom_metrics_merged", PAIRED + f"""SELECT split, {r('median(abs(yhat - y))', 'median_error')},
  {r('quantile_cont(yhat - y, 0.9)', 'high_error')}, {r('avg(greatest(0.9 * (y - yhat), -0.1 * (y - yhat)))', 'pinball')} FROM pairs GROUP BY 1""")
def custom_metrics_merged(spark, sf):
    """The sketch is as large as the driver's tables are at this scale, so that its quantiles are exact."""
    exact = 1 << 20
    return rounded(merged_metrics(_pairs(spark, sf), "y", "yhat", {
        "median_error": QuantileOf(lambda y, p: abs(p - y), 0.5, exact),
        "high_error": QuantileOf(lambda y, p: p - y, 0.9, exact),
        "pinball": pinball(0.9),
    }, ["split"]))


# Metric tables per horizon, from the persistence errors of the load series.
LOAD_TARGETS = "\nUNION ALL ".join(
    f"""SELECT zone_id, {h} AS horizon, load_mw AS last_y, lead(load_mw, {h}) OVER w AS target FROM demand
WINDOW w AS (PARTITION BY zone_id ORDER BY timestamp_utc, o_orderkey)""" for h in HORIZONS)
WIDE_METRICS = """SELECT zone_id, horizon, avg(abs(last_y - target)) AS mae, avg(last_y - target) AS bias,
  max(abs(last_y - target)) AS worst FROM targets WHERE target IS NOT NULL GROUP BY 1, 2"""
METRICS_WIDE = V.also(V.DEMAND_SQL, targets=LOAD_TARGETS, wide=WIDE_METRICS)


def _wide_metrics(spark, sf):
    frame = V.demand(spark, sf).select("o_orderkey", "zone_id", "timestamp_utc", "load_mw")
    targets = W.targets_long(frame, V.DEMAND, "load_mw", HORIZONS)
    y, last = F.col("target"), F.col("load_mw")
    return M.summarise(targets, ["zone_id", "horizon"], {
        "mae": M.mae(y, last), "bias": M.bias(y, last), "worst": F.max(F.abs(last - y))})


@query("metrics_long", METRICS_WIDE + f"""SELECT zone_id, horizon * 60 AS step, 'mae_by_horizon_min' AS metric, {r('mae', 'value')} FROM wide
UNION ALL SELECT zone_id, horizon * 60, 'bias_by_horizon_min', {r('bias', 'value')} FROM wide""")
def metrics_long(spark, sf):
    return rounded(M.metrics_long(_wide_metrics(spark, sf), 60, ["zone_id"]))


@query("metrics_prefixed", METRICS_WIDE + "\nUNION ALL ".join(
    f"SELECT zone_id, 'h' || horizon || '_{m}' AS key, {r(m, 'value')} FROM wide" for m in ("mae", "bias", "worst")))
def metrics_prefixed(spark, sf):
    return rounded(M.metrics_prefixed(_wide_metrics(spark, sf), ["zone_id"]))


@query("rolling_origin_folds", V.SOLAR_SQL + f"""
, ended AS (SELECT system_id AS unique_id, timestamp_utc AS ds, power_kw AS y,
    max(timestamp_utc) OVER (PARTITION BY system_id) AS e FROM solar)
, cuts AS (SELECT DISTINCT unique_id, k AS fold, e - (3 - k) * INTERVAL 24 HOUR AS cutoff FROM ended, range(3) AS f(k))
, known AS (SELECT c.unique_id, c.fold, arg_max(s.y, s.ds) AS prediction FROM cuts c JOIN ended s
    ON s.unique_id = c.unique_id AND s.ds <= c.cutoff AND s.y IS NOT NULL GROUP BY 1, 2)
SELECT s.unique_id, s.ds, CAST(c.fold AS INTEGER) AS fold, c.cutoff, {r('s.y', 'y')}, {r('prediction')}
FROM cuts c JOIN ended s ON s.unique_id = c.unique_id AND s.ds > c.cutoff AND s.ds <= c.cutoff + INTERVAL 24 HOUR
LEFT JOIN known k ON k.unique_id = c.unique_id AND k.fold = c.fold""")
def rolling_origin_folds(spark, sf):
    frame = FT.long_forecast_frame(V.solar(spark, sf), "solar").select("unique_id", "ds", "y")
    return rounded(persistence_folds(frame, "solar", 96, 3))
