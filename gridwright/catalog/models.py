"""Models as table operations.

Each comes twice: least squares on one or two columns, which SQL states exactly, and, under names in `_boosted`, `_default`
or `_full`, the library's own settings on all columns and horizons, which the tests check on fixtures.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.evaluation import errors_sql, mape_sql
from gridwright.catalog.features import DEMAND_GOOD, _flagged_demand
from gridwright.catalog.registry import query, r, rounded, table
from gridwright.catalog.time import DEMAND_W
from gridwright.config import DEFAULT_HORIZONS, DOMAINS
from gridwright.models import direct as D
from gridwright.models import recursive as RC
from gridwright.operators import features as FT
from gridwright.operators import weather as WX
from gridwright.operators.resample import temporal_split
from gridwright.session import small_table

HORIZONS = list(DEFAULT_HORIZONS)
FEATURES = FT.feature_set("demand_baseline")
LAST = "load_mw_lag1"
STEPS = 24


def least_squares(**settings) -> LinearRegression:
    return LinearRegression(
        featuresCol="features", labelCol="target", predictionCol="prediction", solver="normal", **settings)


# Weather of a day at each of its hours: the price level of the orders of that day.
DAILY_WEATHER = """SELECT day + CAST(hour AS INT) * INTERVAL '1' HOUR AS timestamp_utc, temperature_2m, wind_speed_10m, relative_humidity_2m
FROM (SELECT date_trunc('day', o_orderdate) + INTERVAL '20' YEAR AS day, avg(o_totalprice / 4903.7 - 30) AS temperature_2m,
  avg(o_totalprice / 9803.7) AS wind_speed_10m, avg(o_totalprice / 5003.7) AS relative_humidity_2m FROM {orders} GROUP BY 1)
LATERAL VIEW explode(sequence(0, 23)) AS hour"""
FULL = FT.feature_set("demand_full")


def demand_full_table(spark, sf):
    """The load features of all levels with weather at every horizon, complete rows only, split by year, with targets. Only
    readings with a load count as rows, since every eleventh has none and no window of a week would be whole."""
    weather = spark.sql(DAILY_WEATHER, orders=table(spark, sf, "orders"))
    readings = _flagged_demand(spark, sf).where(F.col("load_mw").isNotNull())
    joined = WX.join_horizons(readings, weather, HORIZONS, DOMAINS["demand"].step_minutes)
    rows = FT.complete_rows(FT.demand_features(joined, "full", V.DEMAND), "demand", "demand_full")
    kept = [c for h in HORIZONS for c in FT.horizon_columns(rows.columns, FULL, h).values()]
    rows = rows.select("timestamp_utc", "zone_id", "o_orderkey", "load_mw", *dict.fromkeys(kept))
    return D.targets_table(temporal_split(rows, 3, 1), V.DEMAND, "load_mw", HORIZONS)


def demand_table(spark, sf):
    """Load features, complete rows only, split by year, with targets."""
    built = FT.demand_features(_flagged_demand(spark, sf), "baseline", V.DEMAND)
    rows = FT.complete_rows(built, "demand", "demand_baseline").select(
        "timestamp_utc", "zone_id", "o_orderkey", "load_mw", *FEATURES)
    return D.targets_table(temporal_split(rows, 3, 1), V.DEMAND, "load_mw", HORIZONS)


_LAGS = DOMAINS["demand"].lags
_LAGGED = ", ".join(f"lag(load_mw, {k}) OVER ({DEMAND_W}) AS lag{k}" for k in _LAGS)
_COMPLETE = " AND ".join(f"lag{k} IS NOT NULL" for k in _LAGS)
LABELLED = V.also(
    DEMAND_GOOD,
    lagged=f"SELECT o_orderkey, zone_id, timestamp_utc, load_mw, {_LAGGED} FROM good",
    complete=f"SELECT * FROM lagged WHERE load_mw IS NOT NULL AND {_COMPLETE}",
    parts="""SELECT *, CASE WHEN timestamp_utc < a + INTERVAL 3 YEAR THEN 'train'
      WHEN timestamp_utc < a + INTERVAL 3 YEAR + INTERVAL 1 YEAR THEN 'val' ELSE 'test' END AS split
      FROM complete, (SELECT min(timestamp_utc) AS a FROM complete) AS m""",
    labelled="SELECT * FROM (" + "\nUNION ALL ".join(
        f"""SELECT CAST({h} AS INTEGER) AS horizon, split, lag1, lead(load_mw, {h}) OVER w AS target FROM parts
        WINDOW w AS (PARTITION BY split, zone_id ORDER BY timestamp_utc, o_orderkey)""" for h in HORIZONS)
    + ") AS t WHERE target IS NOT NULL",
    fitted="""SELECT horizon, regr_slope(target, lag1) AS slope, regr_intercept(target, lag1) AS intercept,
      sum(target * lag1) / sum(lag1 * lag1) AS through_origin, count(*) AS n FROM labelled WHERE split = 'train' GROUP BY 1""")


@query("train_direct_horizons", LABELLED + f"SELECT horizon, {r('slope')}, {r('intercept', digits=2)} FROM fitted")
def train_direct_horizons(spark, sf):
    models = D.train_horizons(demand_table(spark, sf), [LAST], HORIZONS, least_squares())
    rows = [(h, float(m.stages[-1].coefficients[0]), float(m.stages[-1].intercept)) for h, m in models.items()]
    fitted = small_table(spark, rows, "horizon int, slope double, intercept double")
    return fitted.select("horizon", *[
        (F.round(c, n) + 0.0).alias(c) for c, n in (("slope", 4), ("intercept", 2))])


@query("train_direct_horizons_boosted")
def train_direct_horizons_boosted(spark, sf):
    models = D.train_horizons(demand_full_table(spark, sf), FULL, HORIZONS)
    rows = [(h, len(m.trees), len(m.losses) - 1, m.losses[0], m.losses[len(m.trees)]) for h, m in models.items()]
    return rounded(small_table(
        spark, rows, "horizon int, rounds_kept int, rounds_grown int, first_loss double, best_loss double"))


PREDICTED = V.also(LABELLED, predicted="""SELECT horizon, split, target AS y, lag1 AS last_y,
  slope * lag1 + intercept AS yhat, through_origin * lag1 AS flat FROM labelled JOIN fitted USING (horizon) WHERE split <> 'train'""")


@query("predict_evaluate", PREDICTED + f"""SELECT horizon, split, count(*) AS n_rows, {errors_sql('y', 'yhat')}, {mape_sql('y', 'yhat')},
  {r('''1 - sqrt(avg((yhat - y) * (yhat - y))) / sqrt(avg((last_y - y) * (last_y - y)))''', 'skill_score')},
  {r('avg(abs(last_y - y))', 'persistence_mae')}, {r('sqrt(avg((last_y - y) * (last_y - y)))', 'persistence_rmse')},
  {r('avg(last_y - y)', 'persistence_bias')} FROM predicted GROUP BY 1, 2""")
def predict_evaluate(spark, sf):
    rows = demand_table(spark, sf)
    models = D.train_horizons(rows, [LAST], HORIZONS, least_squares())
    return rounded(D.evaluate_horizons(D.predict_horizons(models, rows, [LAST], keep=[LAST]), LAST))


@query("predict_evaluate_boosted")
def predict_evaluate_boosted(spark, sf):
    rows = demand_full_table(spark, sf)
    models = D.train_horizons(rows, FULL, HORIZONS)
    return rounded(D.evaluate_horizons(D.predict_horizons(models, rows, FULL, keep=[LAST]), LAST))


_SCORED = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS model, horizon, avg(abs({c} - y)) AS mae, sqrt(avg(({c} - y) * ({c} - y))) AS rmse
    FROM predicted WHERE split = 'val' GROUP BY 1, 2""" for name, c in (("line", "yhat"), ("through origin", "flat")))


@query("model_leaderboard", V.also(PREDICTED, scored=_SCORED) + f"""SELECT horizon, model, {r('mae')}, {r('rmse')},
  CAST(row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS INTEGER) AS rank FROM scored""")
def model_leaderboard(spark, sf):
    rows = demand_table(spark, sf)
    candidates = {"line": least_squares(), "through origin": least_squares(fitIntercept=False)}
    boards = [D.model_leaderboard(rows, [LAST], h, candidates) for h in D.trainable_horizons(rows, HORIZONS)]
    none = rows.select(
        F.lit(0).alias("horizon"), F.lit("").alias("model"), *[F.lit(0.0).alias(c) for c in ("mae", "rmse")],
        F.lit(0).alias("rank")).limit(0)
    return rounded(reduce(DataFrame.unionByName, boards, none))


@query("model_leaderboard_default")
def model_leaderboard_default(spark, sf):
    return rounded(D.ensemble_leaderboard(demand_full_table(spark, sf), FULL, HORIZONS))


_WIND = DOMAINS["wind"]
_NEED = max(*_WIND.lags, *_WIND.windows)
_BACK = f"PARTITION BY turbine_id ORDER BY timestamp_utc, event_id ROWS BETWEEN {_NEED} PRECEDING AND 1 PRECEDING"
KNOWN = V.also(
    V.SCADA,
    known="SELECT turbine_id, timestamp_utc, event_id, active_power_kw AS y, hour(timestamp_utc) AS hour FROM scada WHERE active_power_kw IS NOT NULL",
    lagged=f"""SELECT *, lag(y) OVER (PARTITION BY turbine_id ORDER BY timestamp_utc, event_id) AS last_y,
    {', '.join(f"lead(y, {h}) OVER (PARTITION BY turbine_id ORDER BY timestamp_utc, event_id) AS target_h{h}" for h in HORIZONS)},
    count(*) OVER ({_BACK}) AS seen FROM known""")
# Least squares on the last value and the hour, then applied again and again from each series' end.
RECURSIVE = KNOWN.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, moments AS (SELECT covar_samp(y, last_y) AS yl, covar_samp(y, hour) AS yh, covar_samp(last_y, hour) AS lh, var_samp(last_y) AS ll,
    var_samp(hour) AS hh, avg(y) AS my, avg(last_y) AS ml, avg(hour) AS mh FROM lagged WHERE seen = {_NEED})
, slopes AS (SELECT *, (yl * hh - yh * lh) / (ll * hh - lh * lh) AS b, (yh * ll - yl * lh) / (ll * hh - lh * lh) AS c FROM moments)
, line AS (SELECT b, c, my - b * ml - c * mh AS a FROM slopes)
, ends AS (SELECT turbine_id, max(timestamp_utc) AS last_ts, max_by(y, (timestamp_utc, event_id)) AS y FROM known
    GROUP BY 1 HAVING count(*) >= {_NEED})
, steps AS (SELECT turbine_id, last_ts, 0 AS k, y AS prediction FROM ends
    UNION ALL SELECT turbine_id, last_ts, k + 1,
      a + b * prediction + c * hour(last_ts + (k + 1) * {_WIND.step_minutes} * INTERVAL 1 MINUTE) FROM steps, line WHERE k < {STEPS})
SELECT turbine_id AS unique_id, last_ts + k * {_WIND.step_minutes} * INTERVAL 1 MINUTE AS ds, {r('prediction')} FROM steps WHERE k > 0"""
KEYED = RC.Series(("unique_id",), "ds", ("event_id",))


def _wind_series(spark, sf):
    series = FT.long_forecast_frame(V.scada(spark, sf), "wind").where(F.col("y").isNotNull())
    return series.select("unique_id", "ds", "event_id", "y", F.hour("ds").cast("double").alias("hour"))


def _forecast(spark, sf, features=None):
    """Every series' next day, from a model that also sees the hour, known for the steps to come."""
    series = _wind_series(spark, sf)
    model = RC.fit_one_step(series, "wind", least_squares(), KEYED, features=features, exogenous=["hour"])
    step = F.expr(f"interval '{_WIND.step_minutes}' minute")
    ahead = F.sequence(F.col("ds") + step, F.col("ds") + STEPS * step, step)
    future = series.groupBy("unique_id").agg(F.max("ds").alias("ds")).select("unique_id", F.explode(ahead).alias("ds"))
    future = future.withColumn("hour", F.hour("ds").cast("double"))
    return rounded(RC.recursive_forecast(series, model, "wind", STEPS, KEYED, future=future, exogenous=["hour"]))


@query("recursive_forecast", RECURSIVE)
def recursive_forecast(spark, sf):
    return _forecast(spark, sf, ["y_lag1"])


@query("recursive_forecast_full")
def recursive_forecast_full(spark, sf):
    return _forecast(spark, sf)


_FOLDS = 3
_SPAN = max(HORIZONS) * _WIND.step_minutes


def _fold_fit(fold: int, h: int) -> str:
    ahead = f"{h * _WIND.step_minutes} * INTERVAL 1 MINUTE"
    return f"""SELECT {fold} AS fold, {h} AS horizon, regr_slope(target_h{h}, last_y) AS b, regr_intercept(target_h{h}, last_y) AS a
    FROM complete WHERE timestamp_utc + {ahead} <= e - {(_FOLDS - fold) * _SPAN} * INTERVAL 1 MINUTE HAVING count(target_h{h}) > 0"""


ROLLING = V.also(
    KNOWN,
    complete=f"""SELECT l.*, e FROM lagged l JOIN (SELECT turbine_id, max(timestamp_utc) AS e FROM known GROUP BY 1) USING (turbine_id)
    WHERE seen = {_NEED}""",
    fits="\nUNION ALL ".join(_fold_fit(f, h) for f in range(_FOLDS) for h in HORIZONS),
    origins="\nUNION ALL ".join(f"""SELECT turbine_id, {f} AS fold, max(e) - {(_FOLDS - f) * _SPAN} * INTERVAL 1 MINUTE AS cutoff,
      max_by(complete, (timestamp_utc, event_id)) AS o FROM complete WHERE timestamp_utc <= e - {(_FOLDS - f) * _SPAN} * INTERVAL 1 MINUTE
      GROUP BY 1""" for f in range(_FOLDS)),
) + "\nUNION ALL ".join(f"""SELECT turbine_id AS unique_id, o.timestamp_utc + {h * _WIND.step_minutes} * INTERVAL 1 MINUTE AS ds, cutoff,
  {r(f'o.target_h{h}', 'y')}, CAST({h} AS INTEGER) AS horizon, {r('a + b * o.last_y', 'prediction')}
  FROM origins JOIN fits USING (fold) WHERE horizon = {h} AND o.target_h{h} IS NOT NULL""" for h in HORIZONS)


@query("rolling_origin_fits", ROLLING)
def rolling_origin_fits(spark, sf):
    return rounded(RC.cross_validate_linear(_wind_series(spark, sf), "wind", HORIZONS, _FOLDS, KEYED, features=["y_lag1"]))


@query("rolling_origin_fits_full")
def rolling_origin_fits_full(spark, sf):
    return rounded(RC.cross_validate_linear(_wind_series(spark, sf), "wind", HORIZONS, _FOLDS, KEYED, exogenous=["hour"]))
