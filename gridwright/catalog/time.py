"""Parsing times, buckets, gap filling, splits and row windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.quality import IS_CLOCK_CHANGE, fill_sql
from gridwright.catalog.registry import query, r, rounded, rs, table, without_zone
from gridwright.config import DEFAULT_HORIZONS
from gridwright.functions import scalars as S
from gridwright.functions.calendars import is_eu_clock_change
from gridwright.operators import features as FT
from gridwright.operators import resample as RS
from gridwright.operators import weather as WX
from gridwright.operators import windows as W
from gridwright.sources.ingest import scale_small_files

WIND_W = "PARTITION BY turbine_id ORDER BY timestamp_utc, event_id"
DEMAND_W = "PARTITION BY zone_id ORDER BY timestamp_utc, o_orderkey"
SOLAR_W = "PARTITION BY system_id ORDER BY timestamp_utc, event_id"


def lag_sql(column: str, lags, window: str) -> str:
    return ", ".join(r(f"lag({column}, {k}) OVER ({window})", f"{column}_lag{k}") for k in lags)


def roll_sql(column: str, widths, window: str, std_up_to: int = 10**6) -> str:
    parts = []
    for w in widths:
        over = f"OVER ({window} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        full = f"count({column}) {over} = {w}"
        parts.append(r(f"CASE WHEN {full} THEN avg({column}) {over} END", f"{column}_roll_mean_{w}"))
        if w <= std_up_to:
            parts.append(r(f"CASE WHEN {full} THEN stddev_samp({column}) {over} END", f"{column}_roll_std_{w}"))
    return ", ".join(parts)


@query("parse_timestamp_utc", "SELECT event_id, date_trunc('second', ts) AS timestamp_utc FROM events")
def parse_timestamp_utc(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id", S.parse_utc(text).cast("timestamp_ntz").alias("timestamp_utc"))


@query("parse_timestamp_offset", """SELECT event_id, date_trunc('second', ts)
  - (event_id % 3 - 1) * INTERVAL 1 HOUR AS timestamp_utc FROM events""")
def parse_timestamp_offset(spark, sf):
    offset = F.expr("CASE event_id % 3 WHEN 0 THEN '-01:00' WHEN 1 THEN '+00:00' ELSE '+01:00' END")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), offset)
    return table(spark, sf, "events").select(
        "event_id", S.parse_with_offset(text).cast("timestamp_ntz").alias("timestamp_utc"))


# Local clock readings: one per order and line, an hour and a half-hour per day of twenty years on.
LOCAL = "o_orderdate + INTERVAL '20' YEAR + CAST(o_orderkey % 48 AS INT) * INTERVAL '30' MINUTE"


def last_sunday(month: int) -> str:
    """SQL for the last Sunday of a month in the year of `local`."""
    end = f"make_date(year(local), {month}, 31)"
    return f"({end} - CAST(isodow({end}) % 7 AS INTEGER))"


def nth_sunday(month: int, n: int) -> str:
    first = f"make_date(year(local), {month}, 1)"
    return f"({first} + CAST((7 - isodow({first})) % 7 + {7 * (n - 1)} AS INTEGER))"


# Central European clock: +2 hours from 02:00 on the last Sunday of March (03:00 once moved) to
# 03:00 on that of October, when a repeated reading takes the earlier instant; else +1 hour.
PARIS_HOURS = f"""CASE WHEN local >= CAST({last_sunday(3)} AS TIMESTAMP) + INTERVAL 3 HOUR
  AND local < CAST({last_sunday(10)} AS TIMESTAMP) + INTERVAL 3 HOUR THEN 2 ELSE 1 END"""
PARIS_GAP = f"""(local >= CAST({last_sunday(3)} AS TIMESTAMP) + INTERVAL 2 HOUR
  AND local < CAST({last_sunday(3)} AS TIMESTAMP) + INTERVAL 3 HOUR)"""
# Denver, from 2007 on: daylight time from the second Sunday of March to the first of November.
DENVER_HOURS = f"""CASE WHEN local >= CAST({nth_sunday(3, 2)} AS TIMESTAMP) + INTERVAL 3 HOUR
  AND local < CAST({nth_sunday(11, 1)} AS TIMESTAMP) + INTERVAL 2 HOUR THEN 6 ELSE 7 END"""


@query("local_to_utc", f"""SELECT o_orderkey, local + ({DENVER_HOURS}) * INTERVAL 1 HOUR AS denver_utc,
  CASE WHEN NOT {PARIS_GAP} THEN local - ({PARIS_HOURS}) * INTERVAL 1 HOUR END AS paris_utc
FROM (SELECT o_orderkey, {LOCAL} AS local FROM orders) AS t""")
def local_to_utc(spark, sf):
    local = table(spark, sf, "orders").select("o_orderkey", F.expr(LOCAL).alias("local"))
    return without_zone(local.select(
        "o_orderkey", S.local_to_utc(F.col("local"), "America/Denver").alias("denver_utc"),
        S.local_to_utc(F.col("local"), "Europe/Paris", drop_gaps=True).alias("paris_utc")))


@query("resample_mean_15min", V.SOLAR_SQL + f"""SELECT system_id, time_bucket(INTERVAL 15 MINUTE, timestamp_utc) AS timestamp_utc,
  {', '.join(r(f'avg({c})', c) for c in ('power_kw', 'poa_wm2', 'ambient_temp_c'))} FROM solar GROUP BY 1, 2""")
def resample_mean_15min(spark, sf):
    return rounded(RS.bucket_mean(
        V.solar(spark, sf), 15, ["power_kw", "poa_wm2", "ambient_temp_c"], ["system_id"]))


@query("resample_mean_hourly", V.DEMAND_SQL + f"""SELECT zone_id, date_trunc('hour', timestamp_utc) AS timestamp_utc,
  {', '.join(r(f'avg({c})', c) for c in ('load_mw', 'tso_forecast_mw'))} FROM demand GROUP BY 1, 2""")
def resample_mean_hourly(spark, sf):
    return rounded(RS.bucket_mean(V.demand(spark, sf), 60, ["load_mw", "tso_forecast_mw"], ["zone_id"]))


def upsample_body(source: str) -> str:
    fills = ", ".join(
        f"last_value(w.{v} IGNORE NULLS) OVER (ORDER BY g.timestamp_utc) AS {v}" for v in V.VARIABLES)
    return f"""SELECT g.timestamp_utc, {fills}
FROM (SELECT unnest(generate_series((SELECT min(timestamp_utc) FROM {source}),
    (SELECT max(timestamp_utc) FROM {source}), INTERVAL 10 MINUTE)) AS timestamp_utc) AS g
LEFT JOIN {source} AS w ON w.timestamp_utc = g.timestamp_utc"""


@query("upsample_ffill", V.also(V.WEATHER, fine=upsample_body("weather_wide")) + f"SELECT timestamp_utc, {rs(V.VARIABLES)} FROM fine")
def upsample_ffill(spark, sf):
    return rounded(WX.upsample(V.weather_wide(spark, sf), 10))


_GRID_CELLS = ", ".join(f"max(CASE WHEN variable = '{v}' THEN value END) AS {v}" for v in V.VARIABLES)


@query("nwp_grid_join", V.WEATHER_LONG + f"""
, wide AS (SELECT location_key, timestamp_utc, {_GRID_CELLS} FROM weather_long GROUP BY 1, 2)
, ends AS (SELECT location_key, min(timestamp_utc) AS a, max(timestamp_utc) AS b FROM wide GROUP BY 1)
, grid AS (SELECT location_key, unnest(generate_series(a, b, INTERVAL 30 MINUTE)) AS timestamp_utc FROM ends)
, filled AS (SELECT g.location_key, g.timestamp_utc,
    {', '.join(f"last_value(w.{v} IGNORE NULLS) OVER (PARTITION BY g.location_key ORDER BY g.timestamp_utc) AS {v}" for v in V.VARIABLES)}
  FROM grid g LEFT JOIN wide w ON w.location_key = g.location_key AND w.timestamp_utc = g.timestamp_utc)
SELECT location_key, timestamp_utc, {rs(V.VARIABLES)} FROM filled""")
def nwp_grid_join(spark, sf):
    keys = ("location_key", "timestamp_utc")
    wide = WX.to_wide(V.weather_long(spark, sf), V.VARIABLES, keys)
    return rounded(WX.upsample(wide, 30, keys=("location_key",)))


FILLED = ["active_power_kw", "wind_speed_ms", "nacelle_temp_c"]


@query("ffill_limit", V.SCADA + f"SELECT event_id, {fill_sql(FILLED, 3, 'turbine_id', 'event_id')} FROM scada")
def ffill_limit(spark, sf):
    frame = V.scada(spark, sf).select("event_id", "turbine_id", "timestamp_utc", *FILLED)
    return rounded(W.fill_forward(frame, V.WIND, FILLED, 3).select("event_id", *FILLED))


# Each event as a short response: up to six values from its hour on, ten minutes apart.
@query("hourly_grid_from_response", f"""SELECT event_id, date_trunc('hour', ts) + k * INTERVAL 10 MINUTE AS timestamp_utc,
  {r('value + k', 'value')} FROM events, range(6) AS g(k) WHERE k <= event_id % 6""")
def hourly_grid_from_response(spark, sf):
    start, n = RS.bucket(F.col("ts"), 60), F.col("event_id") % 6 + 1
    responses = table(spark, sf, "events").select(
        "event_id", start.alias("start"), (start + F.make_dt_interval(mins=(n * 10).cast("int"))).alias("end"),
        F.lit(600).alias("step_seconds"),
        F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.col("value") + k).alias("values"))
    return rounded(WX.hourly_grid(responses))


@query("dst_transition_flag", V.DEMAND_SQL + f"SELECT o_orderkey, {IS_CLOCK_CHANGE} AS is_dst_transition FROM demand")
def dst_transition_flag(spark, sf):
    return V.demand(spark, sf).select(
        "o_orderkey", is_eu_clock_change(F.col("timestamp_utc")).alias("is_dst_transition"))


SPLIT_BODY = """SELECT *, CASE WHEN timestamp_utc < a + INTERVAL 3 YEAR THEN 'train'
  WHEN timestamp_utc < a + INTERVAL 3 YEAR + INTERVAL 1 YEAR THEN 'val' ELSE 'test' END AS split
FROM demand, (SELECT min(timestamp_utc) AS a FROM demand) AS m"""
DEMAND_SPLIT = V.also(V.DEMAND_SQL, parts=SPLIT_BODY)


def demand_split(spark, sf):
    return RS.temporal_split(V.demand(spark, sf), 3, 1)


@query("temporal_split", DEMAND_SPLIT + "SELECT o_orderkey, timestamp_utc, split FROM parts")
def temporal_split(spark, sf):
    return demand_split(spark, sf).select("o_orderkey", "timestamp_utc", "split")


@query("split_stats", DEMAND_SPLIT + """SELECT split, count(*) AS n_rows, min(timestamp_utc) AS first_ts,
  max(timestamp_utc) AS last_ts FROM parts GROUP BY 1""")
def split_stats(spark, sf):
    return RS.split_stats(demand_split(spark, sf))


CUTOFF = "2024-01-12 00:00:00"


@query("blend_at_cutoff", V.also(V.WEATHER, forecast=V.FORECAST_WIDE_BODY) + f"""
SELECT timestamp_utc, {rs(V.VARIABLES[:3])} FROM weather_wide WHERE timestamp_utc < TIMESTAMP '{CUTOFF}'
UNION ALL SELECT timestamp_utc, {rs(V.VARIABLES[:3])} FROM forecast WHERE timestamp_utc >= TIMESTAMP '{CUTOFF}'""")
def blend_at_cutoff(spark, sf):
    reanalysis = V.weather_wide(spark, sf).select("timestamp_utc", *V.VARIABLES[:4])
    forecast = V.forecast_wide(spark, sf).select("timestamp_utc", *V.VARIABLES[:3])
    return rounded(WX.blend(reanalysis, forecast, CUTOFF))


@query("clamp_date_range", """SELECT o_orderkey, least(CAST(o_orderdate AS DATE), DATE '1998-06-30' - 5) AS end_date,
  CAST(o_orderdate + INTERVAL 27 YEAR AS DATE) AS start_date FROM orders""")
def clamp_date_range(spark, sf):
    today = F.lit("1998-06-30").cast("date")
    start = (F.col("o_orderdate") + F.expr("interval '27' year")).cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", WX.clamp_end(F.col("o_orderdate").cast("date"), today).alias("end_date"),
        WX.require_forecast_start(start).alias("start_date"))


@query("horizon_desc", """SELECT event_id, CASE WHEN m < 60 THEN m || ' min ahead' WHEN m < 1440 THEN (m // 60) || 'h ahead'
  ELSE 'D+' || (m // 1440) END AS text FROM (SELECT event_id, (event_id % 400 + 1) * 10 AS m FROM events) AS t""")
def horizon_desc(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.horizon_text(F.col("event_id") % 400 + 1, 10).alias("text"))


# row windows

@query("lag_features", V.SCADA + f"SELECT event_id, {lag_sql('active_power_kw', (1, 2, 3, 6, 12, 24), WIND_W)} FROM scada")
def lag_features(spark, sf):
    frame = V.scada(spark, sf).select("event_id", "turbine_id", "timestamp_utc", "active_power_kw")
    out = W.add_lags(frame, V.WIND, "active_power_kw", [1, 2, 3, 6, 12, 24])
    return rounded(out.drop("turbine_id", "timestamp_utc", "active_power_kw"))


@query("price_lags", V.DEMAND_SQL + f"""SELECT o_orderkey, {r(f'lag(price_eur_mwh, 1) OVER ({DEMAND_W})', 'price_lag1')},
  {r(f'lag(price_eur_mwh, 24) OVER ({DEMAND_W})', 'price_lag24')} FROM demand""")
def price_lags(spark, sf):
    frame = V.demand(spark, sf).select("o_orderkey", "zone_id", "timestamp_utc", "price_eur_mwh")
    out = W.over_series(frame, V.DEMAND, lambda d, w: d.withColumns(FT.price_lags(w)), 24)
    return rounded(out.select("o_orderkey", "price_lag1", "price_lag24"))


MEANS = [f"active_power_kw_roll_mean_{w}" for w in (6, 12, 24)]
STDS = [f"active_power_kw_roll_std_{w}" for w in (6, 12, 24)]
ROLLED = V.also(V.SCADA, rolled=f"SELECT event_id, {roll_sql('active_power_kw', (6, 12, 24), WIND_W)} FROM scada")


def _rolled(spark, sf):
    frame = V.scada(spark, sf).select("event_id", "turbine_id", "timestamp_utc", "active_power_kw")
    return W.add_rolling(frame, V.WIND, "active_power_kw", [6, 12, 24])


@query("rolling_mean", ROLLED + f"SELECT event_id, {', '.join(MEANS)} FROM rolled")
def rolling_mean(spark, sf):
    return rounded(_rolled(spark, sf).select("event_id", *MEANS))


@query("rolling_std", ROLLED + f"SELECT event_id, {', '.join(STDS)} FROM rolled")
def rolling_std(spark, sf):
    return rounded(_rolled(spark, sf).select("event_id", *STDS))


TURBULENCE_OVER = f"OVER ({WIND_W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"
TURBULENCE = f"""coalesce(CASE WHEN count(wind_speed_ms) {TURBULENCE_OVER} = 6
  THEN stddev_samp(wind_speed_ms) {TURBULENCE_OVER} END / wind_speed_ms, 0.0)"""


@query("turbulence_intensity", V.SCADA + f"SELECT event_id, {r(TURBULENCE, 'turbulence_intensity')} FROM scada")
def turbulence_intensity(spark, sf):
    frame = V.scada(spark, sf).select("event_id", "turbine_id", "timestamp_utc", "wind_speed_ms")
    out = W.over_series(
        frame, V.WIND, lambda d, w: d.withColumn("turbulence_intensity", FT.turbulence(w)), 6)
    return rounded(out.select("event_id", "turbulence_intensity"))


TARGET_HORIZONS = list(DEFAULT_HORIZONS)
TARGETS_BODY = "\nUNION ALL ".join(
    f"""SELECT o_orderkey, split, zone_id, {h} AS horizon, lead(load_mw, {h}) OVER w AS target, load_mw FROM parts
WINDOW w AS (PARTITION BY split, zone_id ORDER BY timestamp_utc, o_orderkey)""" for h in TARGET_HORIZONS)


@query("horizon_target", V.also(DEMAND_SPLIT, targets=TARGETS_BODY) + f"""SELECT o_orderkey, split, horizon, {r('target')}
FROM targets WHERE target IS NOT NULL""")
def horizon_target(spark, sf):
    frame = demand_split(spark, sf).select("o_orderkey", "split", "zone_id", "timestamp_utc", "load_mw")
    series = W.Series(("split", "zone_id"), ties=("o_orderkey",))
    out = W.targets_long(frame, series, "load_mw", TARGET_HORIZONS)
    return rounded(out.select("o_orderkey", "split", "horizon", "target"))


@query("direct_targets", V.SOLAR_SQL + "SELECT event_id, horizon, " + r("target") + " FROM (" + "\nUNION ALL ".join(
    f"SELECT event_id, {h} AS horizon, lead(power_kw, {h}) OVER ({SOLAR_W}) AS target FROM solar" for h in range(1, 9)
) + ") AS t WHERE target IS NOT NULL")
def direct_targets(spark, sf):
    frame = V.solar(spark, sf).select("event_id", "system_id", "timestamp_utc", "power_kw")
    out = W.targets_long(frame, V.SOLAR, "power_kw", list(range(1, 9)))
    return rounded(out.select("event_id", "horizon", "target"))


@query("file_unit_fix", f"""SELECT event_id, {r('''CASE WHEN max(p) OVER (PARTITION BY file) < 500 THEN p * 6 ELSE p END''', 'active_power_kw')}
FROM (SELECT event_id, value * (1 + user_id % 3) AS p, 'f' || user_id AS file FROM events) AS t""")
def file_unit_fix(spark, sf):
    frame = table(spark, sf, "events").select(
        "event_id", (F.col("value") * (1 + F.col("user_id") % 3)).alias("active_power_kw"),
        F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("file"))
    return rounded(scale_small_files(frame).drop("file"))


@query("dedupe_first", f"""SELECT user_id, hour_ts, event_id, {r('value')} FROM (SELECT user_id, event_id, value,
  date_trunc('hour', ts) AS hour_ts, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS n
  FROM events) AS t WHERE n = 1""")
def dedupe_first(spark, sf):
    frame = table(spark, sf, "events").select(
        "user_id", RS.bucket(F.col("ts"), 60).alias("hour_ts"), "ts", "event_id", "value")
    out = RS.dedupe_first(frame, ["user_id", "hour_ts"], [F.col("ts"), F.col("event_id")])
    return rounded(out.drop("ts"))


@query("union_all", V.also(V.WEATHER, forecast=V.FORECAST_WIDE_BODY) + f"""SELECT timestamp_utc, {rs(V.VARIABLES)} FROM weather_wide
UNION ALL SELECT timestamp_utc, {rs(V.VARIABLES)} FROM forecast""")
def union_all(spark, sf):
    return rounded(V.weather_wide(spark, sf).unionByName(V.forecast_wide(spark, sf)))


@query("sort", V.SCADA + f"SELECT turbine_id, timestamp_utc, event_id, {r('active_power_kw')} FROM scada ORDER BY 1, 2, 3")
def sort(spark, sf):
    return rounded(V.scada(spark, sf).select("turbine_id", "timestamp_utc", "event_id", "active_power_kw")).orderBy(
        "turbine_id", "timestamp_utc", "event_id")


@query("distinct_values", V.SCADA + "SELECT DISTINCT turbine_id FROM scada")
def distinct_values(spark, sf):
    return V.scada(spark, sf).select("turbine_id").distinct()


@query("group_mean", V.WEATHER_LONG + f"SELECT timestamp_utc, {r('avg(value)', 'value')} FROM weather_long GROUP BY 1")
def group_mean(spark, sf):
    return rounded(RS.group_mean(V.weather_long(spark, sf), ["value"]))


@query("unpivot", V.WEATHER + "\nUNION ALL ".join(
    f"SELECT timestamp_utc, '{v}' AS variable, {r(v, 'value')} FROM weather_wide" for v in V.VARIABLES))
def unpivot(spark, sf):
    return rounded(WX.to_long(V.weather_wide(spark, sf), ["timestamp_utc"]))


@query("pivot", V.WEATHER_LONG + "SELECT location_key, timestamp_utc, " + ", ".join(
    r(f"max(CASE WHEN variable = '{v}' THEN value END)", v) for v in V.VARIABLES) + " FROM weather_long GROUP BY 1, 2")
def pivot(spark, sf):
    return rounded(WX.to_wide(V.weather_long(spark, sf), V.VARIABLES, ("location_key", "timestamp_utc")))
