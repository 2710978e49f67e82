"""Vendor files to canonical tables, before quality control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwright.functions import scalars as S
from gridwright.operators.resample import bucket_mean, dedupe_first, group_mean
from gridwright.schemas import to_canonical
from gridwright.session import work_path, written
from gridwright.sources.archives import write_members
from gridwright.sources.delimited import (
    MAX_BROADCAST_FILES,
    Delimited,
    Format,
    has,
    read_delimited,
    usable,
    with_file_peak,
)
from gridwright.sources.scan import scan_csv

# Vendor headers, null tokens, file-name patterns and time zones.
TURBINE_COLUMNS = {
    "# Date and time": "timestamp_raw",
    "Wind speed (m/s)": "wind_speed_ms",
    "Wind direction (°)": "wind_direction_deg",
    "Power (kW)": "active_power_kw",
    "Nacelle position (°)": "nacelle_direction_deg",
    "Rotor speed (RPM)": "rotor_rpm",
    "Blade angle (pitch position) A (°)": "pitch_a_deg",
    "Blade angle (pitch position) B (°)": "pitch_b_deg",
    "Blade angle (pitch position) C (°)": "pitch_c_deg",
    "Nacelle ambient temperature (°C)": "ambient_temp_c",
    "Nacelle temperature (°C)": "nacelle_temp_c",
    "Data Availability": "data_availability",
}
TURBINE_TIME = "# Date and time"
TURBINE_HEADER = r"^#.*Date and time"
TURBINE_NULLS = ("", "NA", "NaN", "N/A", "-999", "-9999")
TURBINE_MEMBER = r"^Turbine_Data_Kelmarsh_.*\.csv$"
# The name of a file, or of the folder that holds its lines once they are written as text; there %2F, or %252F in a URI, stands for /.
_NAME_END = r"(?:(?!%(?:25)*2F)[^/])*(?:/part-[^/]*)?$"
TURBINE_NUMBER = r"Kelmarsh_(\d+)" + _NAME_END
TURBINE_FILE = r"Turbine_Data_Kelmarsh_" + _NAME_END
TURBINE_PREFIX = "KWF"
UNSCALED_BELOW_KW = 500.0
UNSCALED_FACTOR = 6.0
LOAD_COLUMNS = {
    "Date": "day", "Heures": "clock", "Consommation": "load_mw", "Prévision J-1": "tso_forecast_mw"}
LOAD_HEADER = r"Date\tHeures.*Consommation|Consommation.*Date\tHeures"
LOAD_NULLS = ("ND", "-", "DC", "")
LOAD_MEMBER = r"\.xls$"
LOAD_ENCODING = "ISO-8859-1"
LOAD_ZONE = "Europe/Paris"
PV_COLUMNS = {
    "measured_on": "measured_on",
    "ac_power__315": "power_watts",
    "poa_irradiance__313": "poa_wm2",
    "ambient_temp__320": "ambient_temp_c",
    "module_temp_1__321": "module_temp_c",
}
PV_TIME = "measured_on"
PV_NULLS = ("", "NA", "NaN")
PV_ZONE = "America/Denver"
WEATHER_OUTLIERS = [("Barcelona", "pressure", 1100.0), ("Valencia", "wind_speed", 50.0)]

_SIGNALS = ("wind_speed_ms", "wind_direction_deg", "active_power_kw", "nacelle_direction_deg",
            "rotor_rpm", "ambient_temp_c", "nacelle_temp_c")
_PITCH = ("pitch_a_deg", "pitch_b_deg", "pitch_c_deg")


def series_id_from_path(path: Column) -> Column:
    """Turbine id from the file's own name, whatever its folders are called; fails the job where it has none."""
    number = F.regexp_extract(path, TURBINE_NUMBER, 1)
    problem = F.concat(F.lit("no turbine number in file path "), path)
    return F.when(number != "", F.concat(F.lit(TURBINE_PREFIX), number)).otherwise(
        F.raise_error(problem).cast("string"))


def scale_small_files(df: DataFrame, by: str = "file", n_files: int | None = None) -> DataFrame:
    """Files whose largest power is small hold energy per 10 minutes: six times that is power."""
    peaked = with_file_peak(df, "active_power_kw", by, n_files)
    power = F.col("active_power_kw")
    scaled = F.when(F.col("_peak") < UNSCALED_BELOW_KW, power * UNSCALED_FACTOR).otherwise(power)
    return peaked.withColumn("active_power_kw", scaled).drop("_peak")


def read_turbine_csv(spark: SparkSession, path: str, pattern: str = "*.csv*") -> Delimited:
    """Turbine CSVs with `#` comment lines and a header that itself starts with `#`. Other files of the vendor in the same
    folder are not looked at."""
    fmt = Format(TURBINE_HEADER, comment="#")
    return read_delimited(spark, path, TURBINE_COLUMNS, fmt, pattern, TURBINE_FILE, needed=[TURBINE_TIME])


def ingest_turbine_csv(spark: SparkSession, path: str, pattern: str = "*.csv*") -> DataFrame:
    """A folder of turbine CSVs to the canonical table. The parsed rows are written, since the files' peaks need a second look."""
    read = usable(read_turbine_csv(spark, path, pattern), path, "turbine data")
    number = {c: S.number_or_null(F.col(c), TURBINE_NULLS) for c in (*_SIGNALS, *_PITCH)}
    status = S.status_from_availability(S.number_or_null(F.col("data_availability"), TURBINE_NULLS))
    parsed = written(read.rows.select(
        "file_no", "position", S.parse_utc(F.trim("timestamp_raw")).alias("timestamp_utc"),
        *[number[c].alias(c) for c in _SIGNALS], S.mean_horizontal(*[number[c] for c in _PITCH]).alias("pitch_angle_deg"),
        F.when(has(TURBINE_COLUMNS, "data_availability"), status).otherwise(0).alias("status_code")), "parsed")
    files = read.files.where("fault is null").select("file_no", series_id_from_path(F.col("file")).alias("turbine_id"))
    few = read.n_files <= MAX_BROADCAST_FILES
    named = scale_small_files(parsed, "file_no", read.n_files).join(F.broadcast(files) if few else files, "file_no")
    first = dedupe_first(
        named, ["timestamp_utc", "turbine_id"], [F.col("file_no"), F.col("position")])
    unique = first.withColumns({"dataset_id": F.lit("kelmarsh"), **init_flags("wind")})
    return to_canonical(unique, "wind")


def ingest_turbine_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Turbine archives (files or folders) to the canonical table, nested archives included."""
    text = write_members(spark, paths, work_path(spark, "turbine-members"), TURBINE_MEMBER)
    return ingest_turbine_csv(spark, text, "*")


def ingest_load_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Yearly load archives (files or folders) to the canonical table."""
    text = write_members(spark, paths, work_path(spark, "load-members"), LOAD_MEMBER, LOAD_ENCODING)
    return ingest_load_tsv(spark, text)


def init_flags(domain: str) -> dict[str, Column]:
    flags = {"wind": ("is_curtailed", "is_maintenance"), "demand": ("is_holiday", "is_dst_transition"),
             "solar": ()}[domain]
    return {**{f: F.lit(False) for f in flags}, "qc_flag": F.lit(0).cast("tinyint")}


def read_load_tsv(spark: SparkSession, path: str, encoding: str = "UTF-8", pattern: str = "*") -> Delimited:
    return read_delimited(
        spark, path, LOAD_COLUMNS, Format(LOAD_HEADER, "\t", encoding), pattern, needed=list(LOAD_COLUMNS))


def ingest_load_tsv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", pattern: str = "*"
) -> DataFrame:
    """A folder of yearly load files: local time, quarter-hours, a trailer line without a date."""
    rows = usable(read_load_tsv(spark, path, encoding, pattern), path, "load files").rows
    dated = drop_trailer_rows(rows, ("day", "clock"), LOAD_NULLS)
    local = F.try_to_timestamp(F.concat_ws(" ", "day", "clock"), F.lit("yyyy-MM-dd HH:mm"))
    readings = dated.select(
        S.local_to_utc(local, LOAD_ZONE, drop_gaps=True).alias("timestamp_utc"),
        *[S.number_or_null(F.col(c), LOAD_NULLS).alias(c) for c in ("load_mw", "tso_forecast_mw")],
    ).where(F.col("timestamp_utc").isNotNull())
    hourly = bucket_mean(readings, 60, ["load_mw", "tso_forecast_mw"])
    flagged = hourly.withColumns(
        {"dataset_id": F.lit("rte_france"), "zone_id": F.lit("FR"), **init_flags("demand")})
    return to_canonical(flagged, "demand")


def drop_trailer_rows(
    df: DataFrame, columns: tuple[str, ...], null_tokens: tuple[str, ...] = ()
) -> DataFrame:
    """Keep rows in which all the columns have a value that is no null token."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
        if null_tokens:
            keep = keep & ~F.col(c).isin(*null_tokens)
    return df.where(keep)


def null_outliers(df: DataFrame, rules=tuple(WEATHER_OUTLIERS), place: str = "city_name") -> DataFrame:
    """Set readings above a place's limit to null."""
    return df.withColumns({
        column: F.when(~F.coalesce((F.col(place) == name) & (F.col(column) > limit), F.lit(False)),
                       F.col(column))
        for name, column, limit in rules
    })


def ingest_load_and_weather(spark: SparkSession, energy_path: str, weather_path: str) -> DataFrame:
    """Hourly load and prices joined with the mean weather of the cities."""
    energy = scan_csv(spark, energy_path, numbers=("total load actual", "price day ahead"))
    renamed = {"total load actual": "load_mw", "price day ahead": "price_eur_mwh"}
    load = energy.select(
        S.parse_with_offset(F.col("time")).alias("timestamp_utc"),
        *[F.col(f"`{c}`").alias(n) for c, n in renamed.items() if c in energy.columns])
    cities = scan_csv(
        spark, weather_path, numbers=("temp", "pressure", "humidity", "wind_speed"))
    clean = null_outliers(cities.withColumn("city_name", F.trim("city_name"))).select(
        S.parse_with_offset(F.col("dt_iso")).alias("timestamp_utc"),
        S.kelvin_to_celsius(F.col("temp")).alias("temperature_c"),
        F.col("humidity").alias("humidity_pct"), F.col("wind_speed").alias("wind_speed_ms"))
    weather = group_mean(clean, ["temperature_c", "humidity_pct", "wind_speed_ms"])
    joined = load.join(weather, "timestamp_utc").withColumns(
        {"dataset_id": F.lit("spain_demand"), "zone_id": F.lit("ES"), **init_flags("demand")})
    return to_canonical(joined, "demand")


def read_pv_csv(spark: SparkSession, path: str, year: int | None = None, pattern: str | None = None) -> Delimited:
    glob = pattern or f"system_4__date_{'' if year is None else f'{year}_'}*.csv"
    signals = [c for c in PV_COLUMNS if c != PV_TIME]
    return read_delimited(spark, path, PV_COLUMNS, Format(PV_TIME), glob, needed=[PV_TIME], any_of=signals)


def ingest_pv_csv(
    spark: SparkSession, path: str, year: int | None = None, pattern: str | None = None
) -> DataFrame:
    """A folder of daily photovoltaic CSVs in local time, averaged to 15 minutes.

    Files without a time column or without any signal are left out.
    """
    raw = usable(read_pv_csv(spark, path, year, pattern), path, "photovoltaic files").rows
    signals = ("poa_wm2", "ambient_temp_c", "module_temp_c")
    rows = raw.select(
        S.local_to_utc(S.parse_utc(F.col("measured_on")), PV_ZONE).alias("timestamp_utc"),
        *[S.number_or_null(F.col(c), PV_NULLS).alias(c) for c in signals],
        F.when(has(PV_COLUMNS, "power_watts"), S.watts_to_kw(S.number_or_null(F.col("power_watts"), PV_NULLS))).alias("power_kw"))
    averaged = bucket_mean(rows, 15, [*signals, "power_kw"]).withColumns(
        {"dataset_id": F.lit("pvdaq_system4"), "system_id": F.lit("4"), **init_flags("solar")})
    return to_canonical(averaged, "solar")
