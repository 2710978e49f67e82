"""Projections, filters, schema work and row-wise functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridwright.catalog import views as V
from gridwright.catalog.registry import query, r, rounded, rs, table, without_zone
from gridwright.functions import scalars as S
from gridwright.operators import features as FT
from gridwright.operators import runs as R
from gridwright.operators.windows import add_lags
from gridwright.schemas import SCADA, empty_frame, to_canonical, validate_schema
from gridwright.sources import ingest as I
from gridwright.sources import scan

SCADA_DOUBLES = [f.name for f in SCADA if f.dataType.simpleString() == "double"]
SCADA_OTHERS = [f.name for f in SCADA if f.dataType.simpleString() != "double"]


@query("scan_parquet", f"SELECT event_id, ts, user_id, event_type, {r('value')}, props FROM events")
def scan_parquet(spark, sf):
    return rounded(scan.scan_parquet(spark, f"{sf}/events.parquet"))


@query("to_canonical_schema", f"""SELECT ts AS timestamp_utc, CAST(NULL AS VARCHAR) AS dataset_id,
  CAST(user_id AS VARCHAR) AS turbine_id, {r('value', 'active_power_kw')},
  {', '.join(f"CAST(NULL AS DOUBLE) AS {c}" for c in SCADA_DOUBLES if c != 'active_power_kw')},
  CAST(event_id % 100 AS INTEGER) AS status_code, CAST(NULL AS BOOLEAN) AS is_curtailed,
  CAST(NULL AS BOOLEAN) AS is_maintenance, CAST(NULL AS TINYINT) AS qc_flag FROM events""")
def to_canonical_schema(spark, sf):
    raw = table(spark, sf, "events").select(
        F.col("value").alias("active_power_kw"), F.col("ts").alias("timestamp_utc"),
        F.col("user_id").alias("turbine_id"), (F.col("event_id") % 100).alias("status_code"))
    return without_zone(rounded(to_canonical(raw, "wind")))


@query("rename_select_columns", f"""SELECT ts AS timestamp_utc, CAST(user_id AS VARCHAR) AS turbine_id,
  {r('value', 'active_power_kw')} FROM events""")
def rename_select_columns(spark, sf):
    mapped = {"ts": "timestamp_utc", "user_id": "turbine_id", "value": "active_power_kw", "absent": "rotor_rpm"}
    events = table(spark, sf, "events")
    kept = events.select(*[F.col(a).alias(b) for a, b in mapped.items() if a in events.columns])
    return rounded(kept.withColumn("turbine_id", F.col("turbine_id").cast("string")))


@query("validate_schema", """SELECT column_name, error, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES
  ('timestamp_utc', 'expected timestamp, got timestamp_ntz'), ('humidity_pct', 'missing'),
  ('load_mw', 'expected double, got string'), ('o_orderkey', 'unexpected')) AS e(column_name, error)""")
def validate(spark, sf):
    frame = V.demand(spark, sf).drop("humidity_pct").withColumn("load_mw", F.col("load_mw").cast("string"))
    total = frame.agg(F.count("*")).scalar()
    return validate_schema(frame, "demand", strict=True).withColumn("n_rows", total)


@query("empty_canonical_frame", V.SCADA + f"SELECT {', '.join(SCADA_OTHERS)}, {rs(SCADA_DOUBLES)} FROM scada")
def empty_canonical_frame(spark, sf):
    rows = to_canonical(V.scada(spark, sf), "wind")
    return without_zone(rounded(empty_frame(spark, "wind").unionByName(rows)))


@query("init_flags", """SELECT o_orderkey, 'rte_france' AS dataset_id, 'FR' AS zone_id, false AS is_holiday,
  false AS is_dst_transition, CAST(0 AS TINYINT) AS qc_flag FROM orders""")
def init_flags(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey").withColumns(
        {"dataset_id": F.lit("rte_france"), "zone_id": F.lit("FR"), **I.init_flags("demand")})


# Readings as text with null tokens and junk among them.
TEXT_READING = """CASE WHEN event_id % 9 = 0 THEN 'NA' WHEN event_id % 7 = 0 THEN '-999'
  WHEN event_id % 5 = 0 THEN 'broken' WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 3 AS STRING) END"""
DUCK_READING = TEXT_READING.replace("STRING", "VARCHAR")


@query("cast_lenient", f"""SELECT event_id, CASE WHEN reading NOT IN ('NA', '-999') THEN TRY_CAST(reading AS DOUBLE) END AS x
FROM (SELECT event_id, {DUCK_READING} AS reading FROM events) AS t""")
def cast_lenient(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.number_or_null(F.expr(TEXT_READING), I.TURBINE_NULLS).alias("x"))


@query("status_from_availability", f"""SELECT event_id,
  CASE WHEN TRY_CAST({DUCK_READING} AS DOUBLE) = 0 THEN 1 ELSE 0 END AS status_code FROM events""")
def status_from_availability(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", S.status_from_availability(F.expr(TEXT_READING)).alias("status_code"))


@query("drop_null_features", V.also(V.SCADA, featured="""
  SELECT event_id, active_power_kw, wind_speed_ms, lag(active_power_kw, 1) OVER w AS active_power_kw_lag1,
    nacelle_temp_c AS nwp_temperature_2m_h1, rotor_rpm FROM scada
  WINDOW w AS (PARTITION BY turbine_id ORDER BY timestamp_utc, event_id)""") + f"""
SELECT event_id, {rs(['active_power_kw', 'wind_speed_ms', 'active_power_kw_lag1', 'nwp_temperature_2m_h1', 'rotor_rpm'])}
FROM featured WHERE active_power_kw IS NOT NULL AND wind_speed_ms IS NOT NULL
  AND active_power_kw_lag1 IS NOT NULL AND nwp_temperature_2m_h1 IS NOT NULL""")
def drop_null_features(spark, sf):
    frame = add_lags(V.scada(spark, sf), V.WIND, "active_power_kw", [1]).select(
        "event_id", "active_power_kw", "wind_speed_ms", "active_power_kw_lag1",
        F.col("nacelle_temp_c").alias("nwp_temperature_2m_h1"), "rotor_rpm")
    return rounded(FT.complete_rows(frame, "wind", "wind_full"))


@query("drop_null_pairs", V.DEMAND_SQL + f"""SELECT o_orderkey, {rs(['load_mw', 'tso_forecast_mw'])} FROM demand
WHERE load_mw IS NOT NULL AND tso_forecast_mw IS NOT NULL""")
def drop_null_pairs(spark, sf):
    pairs = V.demand(spark, sf).dropna(subset=["load_mw", "tso_forecast_mw"])
    return rounded(pairs.select("o_orderkey", "load_mw", "tso_forecast_mw"))


CITY = """CASE event_type WHEN 'view' THEN 'Barcelona' WHEN 'click' THEN 'Valencia' WHEN 'error' THEN NULL
  ELSE 'Madrid' END"""


@query("conditional_null_outliers", f"""SELECT event_id,
  {r("CASE WHEN city = 'Barcelona' AND pressure > 1100 THEN NULL ELSE pressure END", 'pressure')},
  {r("CASE WHEN city = 'Valencia' AND wind_speed > 50 THEN NULL ELSE wind_speed END", 'wind_speed')}
FROM (SELECT event_id, {CITY} AS city, value * 30 AS pressure, value AS wind_speed FROM events) AS t""")
def conditional_null_outliers(spark, sf):
    frame = table(spark, sf, "events").select(
        "event_id", F.expr(CITY).alias("city_name"), (F.col("value") * 30).alias("pressure"),
        F.col("value").alias("wind_speed"))
    return rounded(I.null_outliers(frame).drop("city_name"))


DAY = "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'ND' ELSE 'd' END"
CLOCK = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE '00:00' END"


@query("drop_trailer_rows", f"SELECT event_id FROM events WHERE {DAY} = 'd' AND {CLOCK} IS NOT NULL")
def drop_trailer_rows(spark, sf):
    frame = table(spark, sf, "events").select("event_id", F.expr(DAY).alias("day"), F.expr(CLOCK).alias("clock"))
    return I.drop_trailer_rows(frame, ("day", "clock"), I.LOAD_NULLS).select("event_id")


LONG_REST = [c for c in SCADA_DOUBLES if c not in ("active_power_kw", "nacelle_direction_deg")]


@query("prepare_long_forecast_frame", V.SCADA + f"""SELECT turbine_id AS unique_id, timestamp_utc AS ds,
  {r('active_power_kw', 'y')}, dataset_id, is_curtailed, is_maintenance, event_id, {rs(LONG_REST)} FROM scada""")
def prepare_long_forecast_frame(spark, sf):
    return rounded(FT.long_forecast_frame(V.scada(spark, sf), "wind"))


@query("resolve_horizon_features", f"""SELECT event_id, {r('value', 'load_mw_lag1')},
  {r('value * 6', 'nwp_temperature_2m')}, {r('value * 10', 'nwp_wind_speed_10m')} FROM events""")
def resolve_horizon_features(spark, sf):
    v = F.col("value")
    frame = table(spark, sf, "events").select(
        "event_id", v.alias("load_mw_lag1"), v.alias("nwp_temperature_2m_h1"),
        (v * 6).alias("nwp_temperature_2m_h6"), (v * 10).alias("nwp_wind_speed_10m"))
    wanted = ["load_mw_lag1", "nwp_temperature_2m", "nwp_wind_speed_10m", "nwp_relative_humidity_2m"]
    return rounded(FT.select_horizon(frame, wanted, 6, keep=["event_id"]))


@query("select_feature_set", V.SOLAR_SQL + f"SELECT event_id, {rs(['poa_wm2', 'ambient_temp_c', 'module_temp_c'])} FROM solar")
def select_feature_set(spark, sf):
    return rounded(FT.select_feature_set(V.solar(spark, sf), "solar_exog_enriched", keep=["event_id"]))


# row-wise functions

def _cyc(name: str, angle: str) -> str:
    return f"{r(f'sin({angle})', f'{name}_sin')}, {r(f'cos({angle})', f'{name}_cos')}"


HOUR = _cyc("hour", "hour(ts) * 2 * pi() / 24")
CALENDAR = f"{_cyc('month', 'month(ts) * 2 * pi() / 12')}, {_cyc('dow', 'isodow(ts) * 2 * pi() / 7')}"


@query("cyclic_hour", f"SELECT event_id, {HOUR} FROM events")
def cyclic_hour(spark, sf):
    return rounded(table(spark, sf, "events").select("event_id", "ts").withColumns(
        S.cyclic_hour(F.col("ts"))).drop("ts"))


@query("cyclic_calendar", "WITH t AS (SELECT o_orderkey, o_orderdate AS ts FROM orders) "
       f"SELECT o_orderkey, {HOUR}, {CALENDAR} FROM t")
def cyclic_calendar(spark, sf):
    return rounded(table(spark, sf, "orders").select("o_orderkey", "o_orderdate").withColumns(
        S.cyclic_calendar(F.col("o_orderdate"), with_hour=True)).drop("o_orderdate"))


@query("cyclic_direction", V.SCADA + f"SELECT event_id, {_cyc('wind_dir', 'wind_direction_deg * pi() / 180')} FROM scada")
def cyclic_direction(spark, sf):
    cols = S.cyclic_direction(F.col("wind_direction_deg"))
    return rounded(V.scada(spark, sf).withColumns(cols).select("event_id", *cols))


@query("wind_cubed", V.SCADA + f"SELECT event_id, {r('wind_speed_ms * wind_speed_ms * wind_speed_ms', 'wind_speed_cubed', 3)} FROM scada")
def wind_cubed(spark, sf):
    return rounded(V.scada(spark, sf).select(
        "event_id", F.pow("wind_speed_ms", F.lit(3.0)).alias("wind_speed_cubed")), 3)


@query("wind_dir_sector", V.SCADA + "SELECT event_id, CAST(trunc(wind_direction_deg / 30) AS INTEGER) AS wind_dir_sector FROM scada")
def wind_dir_sector(spark, sf):
    return V.scada(spark, sf).select(
        "event_id", S.direction_sector(F.col("wind_direction_deg")).alias("wind_dir_sector"))


@query("degree_days", V.DEMAND_SQL + f"""SELECT o_orderkey, {r('greatest(0.0, 18.0 - temperature_c)', 'heating_degree_days')},
  {r('greatest(0.0, temperature_c - 24.0)', 'cooling_degree_days')} FROM demand""")
def degree_days(spark, sf):
    cols = S.degree_days(F.col("temperature_c"))
    return rounded(V.demand(spark, sf).withColumns(cols).select("o_orderkey", *cols))


@query("clearsky_ratio", V.SOLAR_SQL + f"""SELECT event_id,
  {r('CASE WHEN poa_wm2 > 0 THEN least(poa_wm2 / 1200.0, 1.5) ELSE 0.0 END', 'clearsky_ratio')} FROM solar""")
def clearsky_ratio(spark, sf):
    return rounded(V.solar(spark, sf).select(
        "event_id", S.clearsky_ratio(F.col("poa_wm2")).alias("clearsky_ratio")))


@query("mean_horizontal", V.SCADA + f"""SELECT event_id, {r('''(coalesce(wind_speed_ms, 0) + coalesce(rotor_rpm, 0)
  + coalesce(nacelle_temp_c, 0)) / nullif((wind_speed_ms IS NOT NULL)::INT + (rotor_rpm IS NOT NULL)::INT
  + (nacelle_temp_c IS NOT NULL)::INT, 0)''', 'mean_value')} FROM scada""")
def mean_horizontal(spark, sf):
    cols = [F.col(c) for c in ("wind_speed_ms", "rotor_rpm", "nacelle_temp_c")]
    return rounded(V.scada(spark, sf).select("event_id", S.mean_horizontal(*cols).alias("mean_value")))


@query("unit_conversions", V.SCADA + f"""SELECT event_id, {r('greatest(active_power_kw / 1000.0, 0.0)', 'power_kw')},
  {r('nacelle_temp_c - 273.15', 'temperature_c')} FROM scada""")
def unit_conversions(spark, sf):
    return rounded(V.scada(spark, sf).select(
        "event_id", S.watts_to_kw(F.col("active_power_kw")).alias("power_kw"),
        S.kelvin_to_celsius(F.col("nacelle_temp_c")).alias("temperature_c")))


@query("trim_city", "SELECT event_id, event_type AS city_name FROM events")
def trim_city(spark, sf):
    padded = F.concat(F.lit(" "), "event_type", F.lit("  "))
    return table(spark, sf, "events").select("event_id", F.trim(padded).alias("city_name"))


@query("concat_datetime", "SELECT event_id, strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M') AS stamp FROM events")
def concat_datetime(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm")).alias("stamp"))


@query("bool_to_int", "SELECT event_id, CAST(value > 50 AS TINYINT) AS flag FROM events")
def bool_to_int(spark, sf):
    return table(spark, sf, "events").select("event_id", (F.col("value") > 50).cast("tinyint").alias("flag"))


@query("metric_key_parse", V.RUNS + f"""SELECT run_id, metric_key AS key, {r('value')},
  TRY_CAST(nullif(regexp_extract(metric_key, '^h(\\d+)_(.+)$', 1), '') AS INTEGER) AS horizon,
  nullif(regexp_extract(metric_key, '^h(\\d+)_(.+)$', 2), '') AS metric FROM metrics""")
def metric_key_parse(spark, sf):
    return rounded(R.parse_metric_keys(V.metrics(spark, sf)))


@query("feature_set_stem", V.RUNS + """SELECT run_id, CASE WHEN feature_set IS NULL OR feature_set IN ('', 'none')
    THEN 'tso_baseline' WHEN regexp_matches(feature_set, '^(wind|demand|solar)_')
    THEN regexp_replace(feature_set, '^(wind|demand|solar)_', '') ELSE 'other' END AS stem FROM runs""")
def feature_set_stem(spark, sf):
    return V.runs(spark, sf).select("run_id", R.feature_set_stem(F.col("feature_set")).alias("stem"))


@query("location_key", "SELECT c_custkey, CAST(c_custkey / 8.0 AS DOUBLE) || '_' || CAST(c_nationkey / 4.0 AS DOUBLE) AS location_key FROM customer")
def location_key(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", S.location_key(F.col("c_custkey") / 8.0, F.col("c_nationkey") / 4.0).alias("location_key"))
