import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridwright.functions import scalars as S
from gridwright.operators import features as FT
from gridwright.operators.windows import Series
from tests.test_quality import demand, scada, solar


def rows(df, *order):
    return df.orderBy(*(order or ("timestamp_utc",))).collect()


def value(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_feature_sets_nest_and_have_the_expected_sizes():
    sizes = {n: len(FT.feature_set(n)) for n in FT.list_feature_sets()}
    assert len(sizes) == 18
    assert [sizes[f"wind_{k}"] for k in FT.LEVELS] == [11, 16, 23]
    assert [sizes[f"demand_{k}"] for k in FT.LEVELS] == [10, 14, 19]
    assert [sizes[f"solar_{k}"] for k in FT.LEVELS] == [8, 15, 21]
    assert [sizes[f"wind_exog_{k}"] for k in FT.LEVELS] == [3, 8, 15]
    assert [sizes[f"demand_exog_{k}"] for k in FT.LEVELS] == [6, 9, 15]
    assert [sizes[f"solar_exog_{k}"] for k in FT.LEVELS] == [3, 6, 12]
    for family in ("wind", "demand", "solar", "wind_exog", "demand_exog", "solar_exog"):
        base, more, full = (FT.feature_set(f"{family}_{k}") for k in FT.LEVELS)
        assert more[: len(base)] == base and full[: len(more)] == more
    with pytest.raises(ValueError, match="unknown feature set"):
        FT.feature_set("tidal_baseline")


def test_wind_levels_produce_their_sets(spark, ts):
    n = 40
    df = scada(spark, ts, n=n, active_power_kw=[500 + 100 * math.sin(i / 10) for i in range(n)],
               wind_speed_ms=[8 + 2 * math.sin(i / 20) for i in range(n)],
               wind_direction_deg=[(180 + 1.5 * i) % 360 for i in range(n)])
    weather = spark.createDataFrame(
        [(datetime(2021, 1, 1) + timedelta(hours=h), 10 + h / 2, 180.0, 5.0) for h in range(24)],
        "timestamp_utc timestamp, wind_speed_100m double, wind_direction_100m double, temperature_2m double")
    for level in FT.LEVELS:
        out = FT.wind_features(df, level, weather, [1, 6])
        for name in FT.feature_set(f"wind_{level}"):
            wanted = [f"{name}_h1", f"{name}_h6"] if name.startswith("nwp_") else [name]
            assert set(wanted) <= set(out.columns), name
        assert out.count() == n
    last = rows(out)[-1]
    assert last.active_power_kw_lag24 == pytest.approx(500 + 100 * math.sin(1.5))
    # 39 steps of ten minutes is 06:30; six steps on is 07:30, the weather of hour 7.
    assert last.nwp_wind_speed_100m_h6 == 13.5
    complete = FT.complete_rows(out, "wind", "wind_full")
    assert complete.count() == n - 24


def test_bad_rows_leave_before_lags_are_taken(spark, ts):
    df = scada(spark, ts, n=5, qc_flag=[0, 1, 2, 0, 0])
    out = rows(FT.wind_features(df))
    assert [r.active_power_kw for r in out] == [1000.0, 1003.0, 1004.0]
    assert [r.active_power_kw_lag1 for r in out] == [None, 1000.0, 1003.0]


def test_series_do_not_mix(spark, ts):
    a, b = scada(spark, ts, n=3), scada(spark, ts, n=3, turbine_id=["KWF2"] * 3)
    out = rows(FT.wind_features(a.unionByName(b)), "turbine_id", "timestamp_utc")
    assert [r.active_power_kw_lag1 for r in out] == [None, 1000.0, 1001.0] * 2


def test_demand_levels(spark):
    n = 200
    df = demand(spark, n=n, load_mw=[25_000 + 5_000 * math.sin(math.pi * i / 12) for i in range(n)],
                is_holiday=[True] + [False] * (n - 1))
    for level in FT.LEVELS:
        out = FT.demand_features(df, level)
        present = {c for c in FT.feature_set(f"demand_{level}") if not c.startswith("nwp_")}
        assert present <= set(out.columns)
    first, last = rows(out)[0], rows(out)[-1]
    assert (first.is_holiday, last.is_holiday) == (1, 0)
    assert first.load_mw_lag1 is None and first.heating_degree_days == 3.0
    assert last.load_mw_lag168 == pytest.approx(25_000 + 5_000 * math.sin(math.pi * 31 / 12))
    assert "load_mw_roll_std_168" not in out.columns and last.load_mw_roll_std_24 > 0
    assert rows(out)[167].load_mw_roll_mean_168 is None and rows(out)[168].load_mw_roll_mean_168 is not None


def test_degree_days_prefer_the_forecast_temperature(spark):
    df = demand(spark, n=1).withColumn("nwp_temperature_2m_h1", F.lit(30.0))
    row = FT.demand_features(df, "full").first()
    assert (row.heating_degree_days, row.cooling_degree_days) == (0.0, 6.0)


def test_solar_levels(spark, ts):
    df = solar(spark, ts, power_kw=[float(i) for i in range(100)])
    for level in FT.LEVELS:
        assert set(FT.feature_set(f"solar_{level}")) <= set(FT.solar_features(df, level).columns)
    last = rows(FT.solar_features(df, "enriched"))[-1]
    assert last.power_kw_lag96 == 3.0 and last.power_kw_roll_mean_96 == pytest.approx(50.5)
    # Two columns the files never fill would otherwise empty the table.
    full = FT.complete_rows(FT.solar_features(df, "full").drop("ghi_wm2", "wind_speed_ms"), "solar", "solar_full")
    assert full.count() == 4


def test_exogenous_variants_have_no_target_lags(spark, ts):
    for out, family in (
        (FT.wind_features(scada(spark, ts), "full", lags=False), "wind_exog"),
        (FT.demand_features(demand(spark), "full", lags=False), "demand_exog"),
        (FT.solar_features(solar(spark, ts, power_kw=[1.0] * 3), "full", lags=False), "solar_exog"),
    ):
        assert not [c for c in out.columns if "_kw_lag" in c or "_mw_lag" in c or "_kw_roll" in c]
        assert {c for c in FT.feature_set(f"{family}_full") if not c.startswith("nwp_")} <= set(out.columns)


@pytest.mark.parametrize("wind,want", [
    ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 2.0], math.sqrt(3.5) / 2), ([3.0] * 6 + [0.0], 0.0),
    ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 0.0], math.inf), ([1.0, None, 3.0, 4.0, 5.0, 6.0, 2.0], 0.0),
    ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None], 0.0)])
def test_turbulence_edges(spark, ts, wind, want):
    out = FT.wind_features(scada(spark, ts, n=7, wind_speed_ms=wind), "enriched")
    assert rows(out)[-1].turbulence_intensity == pytest.approx(want)


def test_calendar_columns_lie_on_the_unit_circle(spark):
    df = demand(spark, n=48)
    out = df.select(*[c.alias(n) for n, c in S.cyclic_calendar(F.col("timestamp_utc"), True).items()])
    for name in ("hour", "dow", "month"):
        length = F.pow(f"{name}_sin", F.lit(2)) + F.pow(f"{name}_cos", F.lit(2))
        assert out.where(F.abs(length - 1) > 1e-12).count() == 0
    # 2015-01-01 was a Thursday, the fourth day of the ISO week.
    first = df.orderBy("timestamp_utc").limit(1).select(
        S.cyclic_calendar(F.col("timestamp_utc"))["dow_sin"].alias("x")).first()
    assert first.x == pytest.approx(math.sin(2 * math.pi * 4 / 7))


def test_scalars(spark):
    assert value(spark, S.direction_sector(F.lit(359.9))) == 11
    assert value(spark, S.direction_sector(F.lit(-29.0))) == 0
    assert value(spark, S.clearsky_ratio(F.lit(3000.0))) == 1.5
    assert value(spark, S.clearsky_ratio(F.lit(None).cast("double"))) == 0.0
    assert value(spark, S.watts_to_kw(F.lit(None).cast("double"))) == 0.0
    assert value(spark, S.mean_horizontal(F.lit(1.0), F.lit(None).cast("double"), F.lit(4.0))) == 2.5
    assert value(spark, S.mean_horizontal(F.lit(None).cast("double"))) is None
    assert value(spark, S.number_or_null(F.lit(" 1.5 "))) == 1.5
    assert value(spark, S.number_or_null(F.lit("NaN"))) is None
    assert value(spark, S.number_or_null(F.lit("-999"), ("-999",))) is None
    assert value(spark, S.location_key(F.lit(52.4016), F.lit(-0.9436))) == "52.4016_-0.9436"
    assert [value(spark, S.horizon_text(F.lit(h), 10)) for h in (1, 5, 6, 143, 144, 300)] == [
        "10 min ahead", "50 min ahead", "1h ahead", "23h ahead", "D+1", "D+2"]


@pytest.mark.parametrize("zone,local,utc,lenient", [
    ("Europe/Paris", "2023-10-29 02:30:00", "2023-10-29 00:30:00", True),
    ("Europe/Paris", "2023-10-29 03:00:00", "2023-10-29 02:00:00", True),
    ("Europe/Paris", "2023-03-26 02:30:00", None, True),
    ("Europe/Paris", "2023-07-01 12:00:00", "2023-07-01 10:00:00", True),
    ("America/Denver", "2020-06-15 12:00:00", "2020-06-15 18:00:00", False),
    ("America/Denver", "2020-01-15 12:00:00", "2020-01-15 19:00:00", False)])
def test_local_to_utc(spark, zone, local, utc, lenient):
    out = value(spark, S.local_to_utc(F.to_timestamp(F.lit(local)), zone, lenient).cast("string"))
    assert out == utc


def test_horizon_columns_prefer_the_matching_variant():
    have = ["load_mw_lag1", "nwp_t_h1", "nwp_t_h6", "nwp_w"]
    assert FT.horizon_columns(have, ["load_mw_lag1", "nwp_t", "nwp_w", "nwp_x", "gone"], 6) == {
        "load_mw_lag1": "load_mw_lag1", "nwp_t": "nwp_t_h6", "nwp_w": "nwp_w"}


def test_long_frame_renames_and_drops_raw_columns(spark, ts):
    out = FT.long_forecast_frame(scada(spark, ts, n=2), "wind")
    assert {"unique_id", "ds", "y"} <= set(out.columns)
    assert not {"qc_flag", "status_code", "nacelle_direction_deg", "turbine_id"} & set(out.columns)


def test_lag_transforms_have_both_statistics_for_every_window(spark, ts):
    df = FT.long_forecast_frame(scada(spark, ts, n=30), "wind").select("unique_id", "ds", "y")
    out = FT.lag_transforms(df, "wind", Series(("unique_id",), "ds")).orderBy("ds").collect()
    assert out[24].y_roll_std_24 == pytest.approx(math.sqrt(50)) and out[23].y_roll_mean_24 is None
