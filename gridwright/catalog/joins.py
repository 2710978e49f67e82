"""Joins, and the stored weather table."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.quality import DEMAND_AND_HOLIDAYS, IS_HOLIDAY
from gridwright.catalog.registry import query, r, rounded, rs, table
from gridwright.catalog.time import upsample_body
from gridwright.config import DEFAULT_HORIZONS
from gridwright.operators import weather as WX
from gridwright.operators.quality import mark_holidays
from gridwright.operators.resample import bucket, bucket_mean

HOURLY_LOAD = """SELECT date_trunc('hour', ts) AS timestamp_utc, avg(value / 1.0337) AS load_mw FROM events GROUP BY 1"""


@query("join_load_weather", V.also(V.WEATHER, hourly=HOURLY_LOAD) + f"""SELECT timestamp_utc, {rs(['load_mw', 'temperature_2m'])}
FROM hourly JOIN weather_wide USING (timestamp_utc)""")
def join_load_weather(spark, sf):
    readings = table(spark, sf, "events").select(
        F.col("ts").alias("timestamp_utc"), (F.col("value") / 1.0337).alias("load_mw"))
    load = bucket_mean(readings, 60, ["load_mw"])
    return rounded(load.join(V.weather_wide(spark, sf), "timestamp_utc").select(
        "timestamp_utc", "load_mw", "temperature_2m"))


NWP = list(V.VARIABLES)
ASKED = ["wind_speed_100m", "temperature_2m"]
NWP_HORIZONS = list(DEFAULT_HORIZONS)
NWP_COLUMNS = [f"nwp_{v}_h{h}" for h in NWP_HORIZONS for v in NWP]
# Observations on the ten-minute marks at or before each event.
TEN_MINUTES = "SELECT event_id, time_bucket(INTERVAL 10 MINUTE, ts) AS timestamp_utc FROM events"


def nwp_sql(observed: str, weather: str, horizons, variables, minutes: int, keep: str) -> str:
    cells = ", ".join(r(f"n{h}.{v}", f"nwp_{v}_h{h}") for h in horizons for v in variables)
    joins = "\n".join(
        f"LEFT JOIN {weather} n{h} ON n{h}.timestamp_utc = o.timestamp_utc + {h * minutes} * INTERVAL 1 MINUTE"
        for h in horizons)
    return f"SELECT {keep}, {cells} FROM {observed} o {joins}"


@query("join_nwp_horizons", V.also(V.WEATHER, fine=upsample_body("weather_wide"), observed=TEN_MINUTES)
       + nwp_sql("observed", "fine", NWP_HORIZONS, NWP, 10, "o.event_id, o.timestamp_utc"))
def join_nwp_horizons(spark, sf):
    observed = table(spark, sf, "events").select("event_id", bucket(F.col("ts"), 10).alias("timestamp_utc"))
    return rounded(WX.join_horizons(observed, V.weather_wide(spark, sf), NWP_HORIZONS, 10, NWP))


@query("join_predictions_actuals", V.SOLAR_SQL + f"""
, preds AS (SELECT system_id AS unique_id, timestamp_utc AS ds, power_kw * 1.1 + 0.01 AS prediction FROM solar
  WHERE event_id % 3 <> 0)
SELECT unique_id, ds, {r('power_kw', 'y')}, {r('prediction')} FROM preds
JOIN solar ON unique_id = system_id AND ds = timestamp_utc""")
def join_predictions_actuals(spark, sf):
    actual = V.solar(spark, sf).select(
        F.col("system_id").alias("unique_id"), F.col("timestamp_utc").alias("ds"),
        F.col("power_kw").alias("y"), "event_id")
    predicted = actual.where("event_id % 3 <> 0").select(
        "unique_id", "ds", (F.col("y") * 1.1 + 0.01).alias("prediction"))
    return rounded(predicted.join(actual.drop("event_id"), ["unique_id", "ds"]))


@query("join_holiday_calendar", DEMAND_AND_HOLIDAYS + f"""SELECT dataset_id, CAST(timestamp_utc AS DATE) AS day,
  count(*) AS n_rows FROM demand AS q WHERE {IS_HOLIDAY} GROUP BY 1, 2""")
def join_holiday_calendar(spark, sf):
    marked = mark_holidays(V.demand(spark, sf)).where("is_holiday")
    return marked.groupBy("dataset_id", F.to_date("timestamp_utc").alias("day")).agg(
        F.count("*").alias("n_rows"))


# stored weather

@query("weather_query", V.WEATHER_LONG + f"""SELECT timestamp_utc,
  {', '.join(r(f"max(CASE WHEN variable = '{v}' THEN value END)", v) for v in ASKED)} FROM weather_long
WHERE location_key = 'loc3' AND timestamp_utc >= DATE '2024-01-05' AND timestamp_utc <= TIMESTAMP '2024-01-20 23:59:59'
  AND variable IN ('{ASKED[0]}', '{ASKED[1]}') GROUP BY 1""")
def weather_query(spark, sf):
    return rounded(WX.query_long(V.weather_long(spark, sf), "loc3", "2024-01-05", "2024-01-20", ASKED))


@query("weather_coverage", V.WEATHER_LONG + """SELECT location_key, min(timestamp_utc) AS first_ts,
  max(timestamp_utc) AS last_ts FROM weather_long GROUP BY 1""")
def weather_coverage(spark, sf):
    return WX.coverage(V.weather_long(spark, sf))


# One fetch request per order, for the location its customer falls to.
REQUESTS = """SELECT o_orderkey, concat('loc', CAST(o_custkey % 9 AS STRING)) AS location_key,
  CAST(o_orderdate + INTERVAL '25' YEAR AS DATE) AS start_date,
  CAST(o_orderdate + INTERVAL '25' YEAR + INTERVAL '400' DAY AS DATE) AS end_date FROM orders"""


@query("missing_ranges", V.also(
    V.WEATHER_LONG, requests=REQUESTS.replace("STRING", "VARCHAR"),
    cover="SELECT location_key, CAST(min(timestamp_utc) AS DATE) AS a, CAST(max(timestamp_utc) AS DATE) AS b FROM weather_long GROUP BY 1",
    joined="SELECT * FROM requests LEFT JOIN cover USING (location_key)") + """
SELECT location_key, 'all' AS part, start_date AS from_date, end_date AS to_date FROM joined WHERE a IS NULL
UNION ALL SELECT location_key, 'before', start_date, a FROM joined WHERE start_date < a
UNION ALL SELECT location_key, 'after', b, end_date FROM joined WHERE end_date > b""")
def missing_ranges(spark, sf):
    requested = spark.sql(REQUESTS.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf, "orders"))
    return WX.missing_ranges(requested, WX.coverage(V.weather_long(spark, sf)))


@query("weighted_mean_points", V.also(V.WEATHER_LONG, points=V.POINTS_BODY) + f"""SELECT timestamp_utc, variable,
  {r('sum(weight * value) / sum(CASE WHEN value IS NOT NULL THEN weight END)', 'value')}
FROM weather_long JOIN points USING (location_key) GROUP BY 1, 2""")
def weighted_mean_points(spark, sf):
    return rounded(WX.weighted_mean(V.weather_long(spark, sf), V.points(spark, sf)))
