"""Quality rules, pipelines and summaries."""

from __future__ import annotations

from gridwright.catalog import views as V
from gridwright.catalog.registry import query, r, rounded
from gridwright.operators import quality as Q
from gridwright.schemas import SIGNALS

POWER_SCORE = "CASE WHEN active_power_kw < 0 THEN 2 WHEN active_power_kw > 2050.0 * 1.05 THEN 1 ELSE 0 END"
WIND_SCORE = "CASE WHEN wind_speed_ms < 0 THEN 2 WHEN wind_speed_ms > 40 THEN 1 ELSE 0 END"
MAINTENANCE = "CASE WHEN status_code <> 0 THEN true ELSE is_maintenance END"
CURTAILED = """CASE WHEN wind_speed_ms > 8 AND pitch_angle_deg > 3 AND active_power_kw < 1025
  THEN true ELSE is_curtailed END"""
LOAD_SCORE = """CASE WHEN load_mw < 0 THEN 2 WHEN load_mw < 10000 OR load_mw > 100000 THEN 1 ELSE 0 END"""
TEMPERATURE_SCORE = "CASE WHEN temperature_c < -20 OR temperature_c > 50 THEN 1 ELSE 0 END"
DEMAND_WIND_SCORE = "CASE WHEN wind_speed_ms > 50 THEN 1 ELSE 0 END"
NIGHT_SCORE = "CASE WHEN poa_wm2 <= 0 AND power_kw > 0.01 THEN 1 ELSE 0 END"
PV_SCORE = "CASE WHEN power_kw > 5 THEN 1 ELSE 0 END"
IRRADIANCE_SCORE = "CASE WHEN poa_wm2 < -10 OR poa_wm2 > 1500 THEN 1 ELSE 0 END"
AMBIENT_SCORE = "CASE WHEN ambient_temp_c < -30 OR ambient_temp_c > 60 THEN 1 ELSE 0 END"
INVERTER_SCORE = "CASE WHEN poa_wm2 > 200 AND power_kw <= 0 THEN 1 ELSE 0 END"

# The run length is counted the long way here: islands of repeats after each row that is none.
FROZEN = """
SELECT event_id, CASE WHEN sum(repeated) OVER (PARTITION BY turbine_id, island ORDER BY timestamp_utc, event_id) >= 6
    THEN 1 ELSE 0 END AS frozen
FROM (SELECT *, sum(1 - repeated) OVER (PARTITION BY turbine_id ORDER BY timestamp_utc, event_id) AS island
  FROM (SELECT *, CASE WHEN wind_speed_ms = lag(wind_speed_ms) OVER w OR active_power_kw = lag(active_power_kw) OVER w
      OR pitch_angle_deg = lag(pitch_angle_deg) OVER w THEN 1 ELSE 0 END AS repeated
    FROM scada WINDOW w AS (PARTITION BY turbine_id ORDER BY timestamp_utc, event_id)) AS a) AS b"""
# Holidays per calendar, written out as the dates they must come to, and clock changes.
FIXED_HOLIDAYS = {
    "spain_demand": (2015, 2018, "(1,1),(1,6),(5,1),(8,15),(10,12),(11,1),(12,6),(12,8),(12,25)",
                     "2015-04-03 2016-03-25 2017-04-14 2018-03-30"),
    "rte_france": (2014, 2024, "(1,1),(5,1),(5,8),(7,14),(8,15),(11,1),(11,11),(12,25)",
                   "2014-04-21 2014-05-29 2014-06-09 2015-04-06 2015-05-14 2015-05-25 2016-03-28 "
                   "2016-05-05 2016-05-16 2017-04-17 2017-05-25 2017-06-05 2018-04-02 2018-05-10 "
                   "2018-05-21 2019-04-22 2019-05-30 2019-06-10 2020-04-13 2020-05-21 2020-06-01 "
                   "2021-04-05 2021-05-13 2021-05-24 2022-04-18 2022-05-26 2022-06-06 2023-04-10 "
                   "2023-05-18 2023-05-29 2024-04-01 2024-05-09 2024-05-20"),
}
HOLIDAYS = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS ds, make_date(y, m, d) AS holiday
FROM range({first}, {last + 1}) AS t(y), (VALUES {fixed}) AS f(m, d)
UNION ALL SELECT '{name}', unnest([{', '.join(f"DATE '{x}'" for x in movable.split())}])"""
    for name, (first, last, fixed, movable) in FIXED_HOLIDAYS.items())
IS_HOLIDAY = """EXISTS (SELECT 1 FROM holidays h WHERE h.ds = q.dataset_id
  AND h.holiday = CAST(q.timestamp_utc AS DATE))"""
CLOCK_DAYS = """2014-03-30 2014-10-26 2015-03-29 2015-10-25 2016-03-27 2016-10-30 2017-03-26 2017-10-29
 2018-03-25 2018-10-28 2019-03-31 2019-10-27 2020-03-29 2020-10-25 2021-03-28 2021-10-31 2022-03-27
 2022-10-30 2023-03-26 2023-10-29 2024-03-31 2024-10-27""".split()
IS_CLOCK_CHANGE = (
    "(CAST(timestamp_utc AS DATE) IN (" + ", ".join(f"DATE '{d}'" for d in CLOCK_DAYS)
    + ") AND hour(timestamp_utc) BETWEEN 1 AND 3)")


def fill_sql(columns, limit: int, series: str, ties: str, final: bool = True) -> str:
    """Filled columns, rounded where they are the result and exact where a query goes on with them."""
    frame = f"PARTITION BY {series} ORDER BY timestamp_utc, {ties} ROWS BETWEEN {limit} PRECEDING AND CURRENT ROW"
    exact = {c: f"last_value({c} IGNORE NULLS) OVER ({frame})" for c in columns}
    return ", ".join(r(e, c) if final else f"{e} AS {c}" for c, e in exact.items())


def flag(*scores: str) -> str:
    return f"CAST(greatest(0, {', '.join(scores)}) AS TINYINT) AS qc_flag"


def _rule(name, view, cte, source, key, rules, *scores):
    @query(name, cte + f"SELECT {key}, {flag(*scores)} FROM {source}")
    def run(spark, sf):
        return Q.raise_flag(view(spark, sf), rules()).select(key, "qc_flag")


_rule("qc_power_range", V.scada, V.SCADA, "scada", "event_id", lambda: Q.power_range_rules(V.RATED_KW), POWER_SCORE)
_rule("qc_wind_range", V.scada, V.SCADA, "scada", "event_id", Q.wind_range_rules, WIND_SCORE)
_rule("qc_load_range", V.demand, V.DEMAND_SQL, "demand", "o_orderkey", Q.load_range_rules, LOAD_SCORE)
_rule("qc_temperature_range", V.demand, V.DEMAND_SQL, "demand", "o_orderkey", Q.temperature_rules, TEMPERATURE_SCORE)
_rule("qc_demand_wind_range", V.demand, V.DEMAND_SQL, "demand", "o_orderkey", Q.demand_wind_rules, DEMAND_WIND_SCORE)
_rule("qc_night_power", V.solar, V.SOLAR_SQL, "solar", "event_id", Q.night_power_rules, NIGHT_SCORE)
_rule("qc_pv_power_range", V.solar, V.SOLAR_SQL, "solar", "event_id", Q.pv_power_rules, PV_SCORE)
_rule("qc_irradiance_range", V.solar, V.SOLAR_SQL, "solar", "event_id", Q.irradiance_rules, IRRADIANCE_SCORE)
_rule("qc_ambient_range", V.solar, V.SOLAR_SQL, "solar", "event_id", Q.ambient_rules, AMBIENT_SCORE)
_rule("qc_power_irradiance", V.solar, V.SOLAR_SQL, "solar", "event_id", Q.dead_inverter_rules, INVERTER_SCORE)


@query("qc_maintenance", V.SCADA + f"SELECT event_id, {MAINTENANCE} AS is_maintenance FROM scada")
def qc_maintenance(spark, sf):
    return V.scada(spark, sf).select("event_id", Q.in_maintenance().alias("is_maintenance"))


@query("qc_curtailment", V.SCADA + f"SELECT event_id, {CURTAILED} AS is_curtailed FROM scada")
def qc_curtailment(spark, sf):
    return V.scada(spark, sf).select("event_id", Q.is_curtailed(V.RATED_KW).alias("is_curtailed"))


@query("qc_frozen_sensor", V.SCADA + f"SELECT event_id, CAST(frozen AS TINYINT) AS qc_flag FROM ({FROZEN}) AS f")
def qc_frozen_sensor(spark, sf):
    return Q.flag_frozen(V.scada(spark, sf), V.WIND).select("event_id", "qc_flag")


def qc_wind_sql(final: bool) -> str:
    return f"""
SELECT event_id, turbine_id, timestamp_utc, {flag(POWER_SCORE, WIND_SCORE, 'frozen')}, {MAINTENANCE} AS is_maintenance,
  {CURTAILED} AS is_curtailed, {fill_sql(SIGNALS['wind'], 3, 'turbine_id', 'event_id', final)}
FROM scada JOIN ({FROZEN}) AS f USING (event_id)"""


@query("qc_wind", V.SCADA + qc_wind_sql(final=True))
def qc_wind(spark, sf):
    return rounded(Q.qc_wind(V.scada(spark, sf), V.RATED_KW, series=V.WIND)).drop(
        "dataset_id", "status_code")


def _summary_sql(*extras: str) -> str:
    parts = ["count(*) AS total_rows"]
    for name, level in (("ok", 0), ("suspect", 1), ("bad", 2)):
        parts.append(f"count(*) FILTER (WHERE qc_flag = {level}) AS qc_{name}")
        parts.append(f"round(100 * count(*) FILTER (WHERE qc_flag = {level}) / count(*), 1) AS qc_{name}_pct")
    return ", ".join([*parts, *extras])


@query("qc_wind_summary", V.also(V.SCADA, flagged=qc_wind_sql(final=False)) + f"""SELECT
  {_summary_sql("count(*) FILTER (WHERE is_curtailed) AS curtailed", "count(*) FILTER (WHERE is_maintenance) AS maintenance")} FROM flagged""")
def qc_wind_summary(spark, sf):
    return Q.qc_summary(Q.qc_wind(V.scada(spark, sf), V.RATED_KW, series=V.WIND), "wind")


QC_DEMAND_BODY = f"""
SELECT o_orderkey, zone_id, timestamp_utc, {flag(LOAD_SCORE, TEMPERATURE_SCORE, DEMAND_WIND_SCORE)},
  {IS_HOLIDAY} AS is_holiday, {IS_CLOCK_CHANGE} AS is_dst_transition,
  {fill_sql(SIGNALS['demand'], 3, 'zone_id', 'o_orderkey')}
FROM demand AS q"""
DEMAND_AND_HOLIDAYS = V.also(V.DEMAND_SQL, holidays=HOLIDAYS)


@query("qc_demand", DEMAND_AND_HOLIDAYS + QC_DEMAND_BODY)
def qc_demand(spark, sf):
    return rounded(Q.qc_demand(V.demand(spark, sf), series=V.DEMAND)).drop("dataset_id")


@query("qc_demand_summary", V.also(DEMAND_AND_HOLIDAYS, flagged=QC_DEMAND_BODY) + f"""SELECT
  {_summary_sql("count(*) FILTER (WHERE is_holiday) AS holidays", "count(*) FILTER (WHERE is_dst_transition) AS dst_transitions")} FROM flagged""")
def qc_demand_summary(spark, sf):
    return Q.qc_summary(Q.qc_demand(V.demand(spark, sf), series=V.DEMAND), "demand")


@query("qc_holiday_flag", DEMAND_AND_HOLIDAYS + f"SELECT o_orderkey, {IS_HOLIDAY} AS is_holiday FROM demand AS q")
def qc_holiday_flag(spark, sf):
    return Q.mark_holidays(V.demand(spark, sf)).select("o_orderkey", "is_holiday")


QC_SOLAR_BODY = f"""
SELECT event_id, system_id, timestamp_utc,
  {flag(NIGHT_SCORE, PV_SCORE, IRRADIANCE_SCORE, AMBIENT_SCORE, INVERTER_SCORE)},
  {fill_sql(SIGNALS['solar'], 4, 'system_id', 'event_id')}
FROM solar"""


@query("qc_solar", V.SOLAR_SQL + QC_SOLAR_BODY)
def qc_solar(spark, sf):
    return rounded(Q.qc_solar(V.solar(spark, sf), series=V.SOLAR)).drop("dataset_id")


@query("qc_solar_summary", V.also(V.SOLAR_SQL, flagged=QC_SOLAR_BODY) + f"SELECT {_summary_sql()} FROM flagged")
def qc_solar_summary(spark, sf):
    return Q.qc_summary(Q.qc_solar(V.solar(spark, sf), series=V.SOLAR), "solar")


@query("filter_qc_ok", V.SCADA + f"""SELECT event_id FROM (SELECT event_id, {flag(POWER_SCORE, WIND_SCORE)} FROM scada) AS f
WHERE qc_flag = 0""")
def filter_qc_ok(spark, sf):
    rules = [*Q.power_range_rules(V.RATED_KW), *Q.wind_range_rules()]
    return Q.keep_ok(Q.raise_flag(V.scada(spark, sf), rules)).select("event_id")
