from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridwright.config import WindLimits
from gridwright.functions.calendars import holiday_dates, is_eu_clock_change
from gridwright.operators import quality as Q
from gridwright.operators.windows import Series
from gridwright.schemas import CANONICAL, empty_frame

RATED = 2000.0


def scada(spark, ts, n=10, **overrides):
    """Quiet readings at 10-minute steps, with whole columns replaced by name."""
    base = {
        "timestamp_utc": [ts(i) for i in range(n)], "dataset_id": ["kelmarsh"] * n, "turbine_id": ["KWF1"] * n,
        "active_power_kw": [1000.0 + i for i in range(n)], "wind_speed_ms": [10.0 + i / 10 for i in range(n)],
        "wind_direction_deg": [180.0] * n, "pitch_angle_deg": [2.0 + i / 100 for i in range(n)],
        "rotor_rpm": [12.0] * n, "nacelle_direction_deg": [180.0] * n, "ambient_temp_c": [10.0] * n,
        "nacelle_temp_c": [25.0] * n, "status_code": [0] * n, "is_curtailed": [False] * n,
        "is_maintenance": [False] * n, "qc_flag": [0] * n,
    }
    base.update(overrides)
    return spark.createDataFrame(list(zip(*base.values())), CANONICAL["wind"])


def demand(spark, n=24, dataset="spain_demand", start=datetime(2015, 1, 1), **overrides):
    base = {
        "timestamp_utc": [start + timedelta(hours=i) for i in range(n)], "dataset_id": [dataset] * n,
        "zone_id": ["ES"] * n, "load_mw": [25_000.0] * n, "temperature_c": [15.0] * n,
        "wind_speed_ms": [5.0] * n, "humidity_pct": [60.0] * n, "price_eur_mwh": [50.0] * n,
        "tso_forecast_mw": [25_000.0] * n, "is_holiday": [False] * n, "is_dst_transition": [False] * n,
        "qc_flag": [0] * n,
    }
    base.update(overrides)
    return spark.createDataFrame(list(zip(*base.values())), CANONICAL["demand"])


def solar(spark, ts, **columns):
    n = len(next(iter(columns.values())))
    base = {
        "timestamp_utc": [ts(i, 15) for i in range(n)], "dataset_id": ["pvdaq_system4"] * n, "system_id": ["4"] * n,
        "power_kw": [1.0] * n, "ghi_wm2": [None] * n, "poa_wm2": [500.0] * n, "ambient_temp_c": [20.0] * n,
        "module_temp_c": [30.0] * n, "wind_speed_ms": [None] * n, "qc_flag": [0] * n,
    }
    base.update(columns)
    return spark.createDataFrame(list(zip(*base.values())), CANONICAL["solar"])


def column(df, name):
    return [r[name] for r in df.orderBy("timestamp_utc").collect()]


def test_wind_ranges_and_worst_flag(spark, ts):
    df = scada(spark, ts, active_power_kw=[-1.0, 0.0, 2100.0, 2100.1, None, 900.0, 901.0, -5.0, 950.0, 960.0],
               wind_speed_ms=[1.0, -0.1, 40.0, 3.0, 4.0, 40.1, 6.0, 41.0, None, 5.0])
    out = Q.qc_wind(df, RATED)
    assert column(out, "qc_flag") == [2, 2, 0, 1, 0, 1, 0, 2, 0, 0]


def test_maintenance_keeps_the_old_value_for_unknown_status(spark, ts):
    df = scada(spark, ts, n=4, status_code=[0, 1, None, 0], is_maintenance=[False, False, True, True])
    assert column(Q.qc_wind(df, RATED), "is_maintenance") == [False, True, True, True]


def test_curtailment_needs_all_three_and_known_power(spark, ts):
    df = scada(spark, ts, n=6, wind_speed_ms=[9.0, 8.0, 9.1, 9.2, 9.3, None],
               pitch_angle_deg=[3.1, 3.2, 3.0, 3.3, 3.4, 3.5],
               active_power_kw=[999.0, 998.0, 997.0, 1000.0, None, 10.0])
    assert column(Q.qc_wind(df, RATED), "is_curtailed") == [True, False, False, False, False, False]


def test_frozen_starts_at_the_sixth_repeat_and_may_mix_signals(spark, ts):
    wind = [5.0, 5.0, 5.0, 5.0, 6.0, 7.0, 8.0, 9.0, 9.5, 9.7]
    power = [1.0, 2.0, 3.0, 4.0, 4.0, 4.0, 4.0, 4.0, 5.0, 6.0]
    df = scada(spark, ts, wind_speed_ms=wind, active_power_kw=power)
    assert column(Q.qc_wind(df, RATED), "qc_flag") == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0]


def test_frozen_is_per_turbine(spark, ts):
    a = scada(spark, ts, n=4, wind_speed_ms=[5.0] * 4)
    b = scada(spark, ts, n=4, wind_speed_ms=[5.0] * 4, turbine_id=["KWF2"] * 4)
    assert set(column(Q.qc_wind(a.unionByName(b), RATED), "qc_flag")) == {0}


def test_fill_stops_after_three_rows_and_flags_judge_the_raw_reading(spark, ts):
    power = [2500.0, None, None, None, None, 10.0, None, 11.0, 12.0, 13.0]
    out = Q.qc_wind(scada(spark, ts, active_power_kw=power), RATED)
    assert column(out, "active_power_kw") == [2500.0, 2500.0, 2500.0, 2500.0, None, 10.0, 10.0, 11.0, 12.0, 13.0]
    assert column(out, "qc_flag") == [1] + [0] * 9


def test_flag_is_reset_and_limits_can_change(spark, ts):
    df = scada(spark, ts, n=3, qc_flag=[2, 2, 2], wind_speed_ms=[20.0, 30.0, 31.0])
    assert column(Q.qc_wind(df, RATED, WindLimits(max_wind_ms=30.0)), "qc_flag") == [0, 0, 1]
    assert Q.qc_wind(df, RATED).columns == df.columns


def test_demand_rules(spark):
    df = demand(spark, n=8, load_mw=[-1.0, 9_999.0, 10_000.0, 100_000.0, 100_001.0, None, 20_000.0, 20_000.0],
                temperature_c=[15.0, 15.0, -20.1, -20.0, 50.0, 50.1, None, 15.0],
                wind_speed_ms=[5.0] * 7 + [50.1])
    assert column(Q.qc_demand(df), "qc_flag") == [2, 1, 1, 0, 1, 1, 0, 1]


def test_demand_fill_is_three_hours(spark):
    out = Q.qc_demand(demand(spark, n=6, load_mw=[20_000.0, None, None, None, None, 21_000.0]))
    assert column(out, "load_mw") == [20_000.0] * 4 + [None, 21_000.0]


@pytest.mark.parametrize("dataset,day,flag", [
    ("spain_demand", datetime(2015, 1, 6), True), ("spain_demand", datetime(2016, 3, 25), True),
    ("spain_demand", datetime(2019, 1, 1), False), ("rte_france", datetime(2023, 7, 14), True),
    ("rte_france", datetime(2024, 5, 20), True), ("rte_france", datetime(2023, 1, 6), False),
    ("elsewhere", datetime(2015, 1, 1), False),
])
def test_holidays_follow_each_rows_dataset(spark, dataset, day, flag):
    assert column(Q.qc_demand(demand(spark, n=1, dataset=dataset, start=day)), "is_holiday") == [flag]


def test_holiday_tables():
    assert len(holiday_dates("spain_demand")) == 40
    # In these years no movable day falls on a fixed one.
    assert len(holiday_dates("rte_france")) == 11 * 11
    assert holiday_dates("unknown") == []


def test_own_calendar_may_be_given(spark):
    calendar = spark.createDataFrame([("x", datetime(2020, 2, 2).date())] * 2, "dataset_id string, holiday date")
    out = Q.mark_holidays(demand(spark, n=2, dataset="x", start=datetime(2020, 2, 1, 23)), calendar)
    assert column(out, "is_holiday") == [False, True]


def test_clock_changes(spark):
    times = [datetime(2018, 3, 25, h) for h in range(5)] + [
        datetime(2018, 10, 28, 2), datetime(2018, 10, 21, 2), datetime(2013, 3, 31, 2), datetime(2025, 3, 30, 2)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp_utc timestamp")
    flags = column(df.withColumn("f", is_eu_clock_change(F.col("timestamp_utc"))), "f")
    by_time = dict(zip(sorted(times), flags))
    assert [by_time[t] for t in times] == [False, True, True, True, False, True, False, False, False]


def test_solar_rules(spark, ts):
    df = solar(
        spark, ts,
        poa_wm2=[0.0, 0.0, -11.0, -10.0, 1500.0, 1500.1, 201.0, 200.0, None, 500.0, 500.0],
        power_kw=[0.02, 0.01, 0.0, 0.0, 5.0, 1.0, 0.0, 0.0, 5.1, None, 1.0],
        ambient_temp_c=[20.0] * 9 + [60.1, -30.0])
    assert column(Q.qc_solar(df), "qc_flag") == [1, 0, 1, 0, 0, 1, 1, 0, 1, 1, 0]


def test_solar_fill_is_four_rows(spark, ts):
    out = Q.qc_solar(solar(spark, ts, power_kw=[1.0, None, None, None, None, None, 2.0]))
    assert column(out, "power_kw") == [1.0] * 5 + [None, 2.0]


def test_summaries(spark, ts):
    flagged = scada(spark, ts, n=3, qc_flag=[0, 1, 2], is_curtailed=[True, False, True])
    row = Q.qc_summary(flagged, "wind").first()
    assert (row.total_rows, row.qc_ok, row.qc_ok_pct, row.qc_bad, row.curtailed, row.maintenance) == (
        3, 1, 33.3, 1, 2, 0)
    empty = Q.qc_summary(empty_frame(spark, "demand"), "demand").first()
    assert empty.total_rows == 0 and empty.qc_ok_pct is None


def test_pipelines_accept_empty_tables(spark):
    assert Q.qc_wind(empty_frame(spark, "wind"), RATED).count() == 0
    assert Q.qc_demand(empty_frame(spark, "demand")).count() == 0
    assert Q.qc_solar(empty_frame(spark, "solar")).count() == 0


def test_qc_needs_one_shuffle_by_series(spark, ts):
    df = scada(spark, ts)
    plan = Q.qc_wind(df, RATED, series=Series(("turbine_id",)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(turbine_id") == 1
    assert plan.count("Sort [turbine_id") == 1
