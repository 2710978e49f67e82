"""Domain-shaped views of the driver tables, on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridwright.catalog.registry import table, without_zone
from gridwright.operators.windows import Series

WIND = Series(("turbine_id",), ties=("event_id",))
DEMAND = Series(("zone_id",), ties=("o_orderkey",))
SOLAR = Series(("system_id",), ties=("event_id",))
RATED_KW = 2050.0

# The view bodies are plain SQL that both engines read alike. Divisors are uneven so that no mean of
# them ends exactly on a rounding edge.
SCADA_BODY = """
SELECT ts AS timestamp_utc, 'kelmarsh' AS dataset_id, concat('T', CAST(user_id AS STRING)) AS turbine_id,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 37 = 0 THEN -value ELSE value / 0.039007 END AS active_power_kw,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 53 = 0 THEN -value ELSE value / 3.9007 END AS wind_speed_ms,
  CAST((event_id * 37) % 360 AS DOUBLE) AS wind_direction_deg,
  CAST(floor((day(ts) - 1) / 4.0) AS DOUBLE) AS pitch_angle_deg,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 9.7001 END AS rotor_rpm,
  CAST((event_id * 41) % 360 AS DOUBLE) AS nacelle_direction_deg,
  value / 4.9003 - 5 AS ambient_temp_c,
  CASE WHEN event_id % 5 < 2 THEN NULL ELSE value / 3.1009 END AS nacelle_temp_c,
  CAST(CASE WHEN event_id % 29 = 0 THEN 1 WHEN event_id % 31 = 0 THEN NULL ELSE 0 END AS INT) AS status_code,
  false AS is_curtailed, false AS is_maintenance, CAST(0 AS TINYINT) AS qc_flag, event_id
FROM events
"""
SOLAR_BODY = """
SELECT ts AS timestamp_utc, 'pvdaq_system4' AS dataset_id, concat('S', CAST(user_id % 12 AS STRING)) AS system_id,
  CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 0.0 ELSE value / 39.007 END AS power_kw,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE value / 0.057003 END AS ghi_wm2,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 0.049003 - 100 END AS poa_wm2,
  value / 1.0103 - 35 AS ambient_temp_c,
  CASE WHEN event_id % 5 < 2 THEN NULL ELSE value / 1.0103 - 20 END AS module_temp_c,
  value / 9.7001 AS wind_speed_ms, CAST(0 AS TINYINT) AS qc_flag, event_id
FROM events
"""
DEMAND_BODY = """
SELECT o_orderdate + INTERVAL '20' YEAR + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS timestamp_utc,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rte_france'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'spain_demand' ELSE 'elsewhere' END AS dataset_id,
  o_orderpriority AS zone_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN -o_totalprice
       ELSE o_totalprice / 3.9007 END AS load_mw,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey % 90 - 30 AS DOUBLE) END AS temperature_c,
  CAST(o_orderkey % 60 AS DOUBLE) AS wind_speed_ms,
  CASE WHEN o_orderkey % 5 < 2 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS humidity_pct,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice / 4903.7 END AS price_eur_mwh,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_totalprice / 3.9007 * (0.9 + (o_custkey % 20) / 100.0) END
    AS tso_forecast_mw,
  false AS is_holiday, false AS is_dst_transition, CAST(0 AS TINYINT) AS qc_flag, o_orderkey
FROM orders
"""
# Hourly weather per location: the event type names the variable.
WEATHER_LONG_BODY = """
SELECT concat('loc', CAST(user_id % 8 AS STRING)) AS location_key, date_trunc('hour', ts) AS timestamp_utc,
  CASE event_type WHEN 'view' THEN 'wind_speed_100m' WHEN 'click' THEN 'wind_direction_100m'
    WHEN 'purchase' THEN 'temperature_2m' WHEN 'signup' THEN 'wind_speed_10m'
    ELSE 'relative_humidity_2m' END AS variable,
  avg(value / 1.0337) AS value
FROM events GROUP BY 1, 2, 3
"""
VARIABLES = ["wind_speed_100m", "wind_direction_100m", "temperature_2m", "wind_speed_10m",
             "relative_humidity_2m"]
_CELLS = ", ".join(f"avg(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in VARIABLES)
WEATHER_WIDE_BODY = f"SELECT timestamp_utc, {_CELLS} FROM weather_long GROUP BY 1"
# A forecast next to the reanalysis: same shape, other values.
FORECAST_WIDE_BODY = (
    "SELECT timestamp_utc, " + ", ".join(f"{v} + 1000 AS {v}" for v in VARIABLES) + " FROM weather_wide")
POINTS_BODY = """
SELECT location_key, (CAST(substr(location_key, 4) AS DOUBLE) + 1) / 36 AS weight
FROM (SELECT DISTINCT location_key FROM weather_long) AS l
"""
# Runs and their metrics from customers: five runs form a parent and its four children.
RUNS_BODY = """
SELECT concat('r', lpad(CAST(c_custkey AS STRING), 9, '0')) AS run_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL
       ELSE concat('r', lpad(CAST(c_custkey - c_custkey % 5 AS STRING), 9, '0')) END AS parent_run_id,
  CASE WHEN c_custkey % 5 = 0 THEN 'parent' ELSE 'child' END AS run_type,
  CASE c_custkey % 7 WHEN 0 THEN 'xgboost' WHEN 1 THEN 'autogluon' WHEN 2 THEN 'mlforecast' WHEN 3 THEN 'tso'
       WHEN 4 THEN NULL ELSE 'other_backend' END AS backend,
  CASE c_custkey % 6 WHEN 0 THEN 'wind_baseline' WHEN 1 THEN 'demand_enriched' WHEN 2 THEN 'solar_full'
       WHEN 3 THEN 'none' WHEN 4 THEN 'custom' ELSE NULL END AS feature_set,
  CASE WHEN c_nationkey % 3 = 0 THEN 'wind' WHEN c_nationkey % 3 = 1 THEN 'demand' ELSE 'solar' END AS domain,
  CASE WHEN c_custkey % 4 = 0 THEN 'LEAKED' ELSE 'CLEAN' END AS data_quality,
  TIMESTAMP '2026-04-09 12:00:00' + CAST(c_custkey % 1440 AS INT) * INTERVAL '1' MINUTE AS start_time,
  c_custkey, c_acctbal
FROM customer
"""
METRIC_NAMES = ("mae", "rmse", "skill_score", "bias", "persistence_mae", "unknown_metric")
RUN_HORIZONS = [1, 6, 12, 24, 48]


# A child reports one horizon, a parent all five; every ninth run also reports the first one.
_KEYS = ", ".join(
    f"('h{h}_{m}', {i}, {h}, {97 * (j + 1)})"
    for i, h in enumerate(RUN_HORIZONS) for j, m in enumerate(METRIC_NAMES)
) + ", ('persistence_rmse', -1, 0, 7), ('persistence_mape', -1, 0, 9)"
_METRIC_WHERE = """
WHERE (i < 0 OR run_type = 'parent' OR c_custkey % 5 = i OR (c_custkey % 9 = 0 AND h = 1))
  AND NOT (metric_key LIKE '%_rmse' AND i >= 0 AND (c_custkey + h) % 3 = 0)"""
METRICS_BODY = f"""
SELECT run_id, metric_key, abs(c_acctbal) / CAST(d AS DOUBLE) + h AS value
FROM runs CROSS JOIN (VALUES {_KEYS}) AS k(metric_key, i, h, d) {_METRIC_WHERE}"""
# The same keys on the Spark side as a generator over each run.
_METRICS_SPARK = f"""
SELECT run_id, metric_key, abs(c_acctbal) / CAST(d AS DOUBLE) + h AS value
FROM runs LATERAL VIEW inline(array({_KEYS})) k AS metric_key, i, h, d {_METRIC_WHERE}"""


def _cte(*views: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in views) + "\n"


SCADA = _cte(("scada", SCADA_BODY))
SOLAR_SQL = _cte(("solar", SOLAR_BODY))
DEMAND_SQL = _cte(("demand", DEMAND_BODY))
WEATHER_LONG = _cte(("weather_long", WEATHER_LONG_BODY))
WEATHER = _cte(("weather_long", WEATHER_LONG_BODY), ("weather_wide", WEATHER_WIDE_BODY))
RUNS = _cte(("runs", RUNS_BODY), ("metrics", METRICS_BODY))


def also(cte: str, **views: str) -> str:
    """Append views to a WITH clause."""
    return cte.rstrip() + "".join(f",\n{name} AS ({body})" for name, body in views.items()) + "\n"


def _view(spark: SparkSession, body: str, **sources: DataFrame) -> DataFrame:
    """Run a view body over frames, without leaving names in the session catalog."""
    return spark.sql(_with_names(body, sources), **sources)


def _with_names(body: str, sources: dict[str, DataFrame]) -> str:
    text = body
    for name in sources:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return text


def scada(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, SCADA_BODY, events=table(spark, sf, "events"))


def solar(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, SOLAR_BODY, events=table(spark, sf, "events"))


def demand(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, DEMAND_BODY, orders=table(spark, sf, "orders"))


def weather_long(spark: SparkSession, sf: str) -> DataFrame:
    return without_zone(_view(spark, WEATHER_LONG_BODY, events=table(spark, sf, "events")))


def weather_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, WEATHER_WIDE_BODY, weather_long=weather_long(spark, sf))


def forecast_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _view(spark, FORECAST_WIDE_BODY, weather_wide=weather_wide(spark, sf))


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of the eight locations."""
    return _view(spark, POINTS_BODY, weather_long=weather_long(spark, sf))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return without_zone(_view(spark, RUNS_BODY, customer=table(spark, sf, "customer")))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    frame = runs(spark, sf)
    return _view(spark, _METRICS_SPARK, runs=frame).withColumnRenamed("metric_key", "key")
