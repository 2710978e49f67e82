"""Canonical table schemas and the operators that check or impose them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.session import small_table


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_D, _S, _B = T.DoubleType(), T.StringType(), T.BooleanType()

# Column names, order and types of the three canonical tables.
SCADA = _schema(
    timestamp_utc=T.TimestampType(), dataset_id=_S, turbine_id=_S, active_power_kw=_D,
    wind_speed_ms=_D, wind_direction_deg=_D, pitch_angle_deg=_D, rotor_rpm=_D,
    nacelle_direction_deg=_D, ambient_temp_c=_D, nacelle_temp_c=_D, status_code=T.IntegerType(),
    is_curtailed=_B, is_maintenance=_B, qc_flag=T.ByteType(),
)
DEMAND = _schema(
    timestamp_utc=T.TimestampType(), dataset_id=_S, zone_id=_S, load_mw=_D, temperature_c=_D,
    wind_speed_ms=_D, humidity_pct=_D, price_eur_mwh=_D, tso_forecast_mw=_D, is_holiday=_B,
    is_dst_transition=_B, qc_flag=T.ByteType(),
)
SOLAR = _schema(
    timestamp_utc=T.TimestampType(), dataset_id=_S, system_id=_S, power_kw=_D, ghi_wm2=_D,
    poa_wm2=_D, ambient_temp_c=_D, module_temp_c=_D, wind_speed_ms=_D, qc_flag=T.ByteType(),
)
CANONICAL = {"wind": SCADA, "demand": DEMAND, "solar": SOLAR}

# Signals are the measured columns: the ones gap filling may touch.
SIGNALS = {
    domain: [f.name for f in schema if isinstance(f.dataType, T.DoubleType)]
    for domain, schema in CANONICAL.items()
}


def empty_frame(spark: SparkSession, domain: str) -> DataFrame:
    return small_table(spark, [], CANONICAL[domain])


def to_canonical(df: DataFrame, domain: str) -> DataFrame:
    """Cast and order the columns; columns the source lacks become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CANONICAL[domain]
        ]
    )


def schema_errors(df: DataFrame, domain: str, strict: bool = False) -> list[tuple[str, str]]:
    """(column, problem) pairs; an empty list means the table conforms. Never raises."""
    actual = {f.name: f.dataType for f in df.schema}
    expected = {f.name: f.dataType for f in CANONICAL[domain]}
    found = [(name, "missing") for name in expected if name not in actual]
    found += [
        (name, f"expected {want.simpleString()}, got {actual[name].simpleString()}")
        for name, want in expected.items()
        if name in actual and actual[name] != want
    ]
    if strict:
        found += [(name, "unexpected") for name in sorted(actual.keys() - expected.keys())]
    return found


def validate_schema(df: DataFrame, domain: str, strict: bool = False) -> DataFrame:
    """The same report as a table, so it can be written next to the data."""
    return small_table(
        df.sparkSession, schema_errors(df, domain, strict), "column_name string, error string")
