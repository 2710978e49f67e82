from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridwright.operators import weather as WX
from gridwright.session import work_path
from gridwright.sources import weather_store
from gridwright.sources.weather_store import read_store, upsert

START = datetime(2023, 1, 1)
WIDE = "timestamp_utc timestamp, wind double, temp double"


def hours(spark, n, wind=lambda h: 10 + h / 2, temp=lambda h: 5 + h / 10, start=START):
    return spark.createDataFrame(
        [(start + timedelta(hours=h), wind(h), temp(h)) for h in range(n)], WIDE)


def test_upsample_repeats_up_to_the_last_source_hour(spark):
    out = WX.upsample(hours(spark, 3), 10).orderBy("timestamp_utc").collect()
    assert len(out) == 13
    assert [r.wind for r in out] == [10.0] * 6 + [10.5] * 6 + [11.0]


def test_upsample_fills_nulls_across_months_and_holes(spark):
    start = datetime(2023, 1, 31, 22)
    rows = [(start, 1.0, None), (start + timedelta(hours=1), None, None),
            (start + timedelta(hours=3), None, 7.0), (start + timedelta(hours=3, minutes=5), 99.0, 99.0),
            (start + timedelta(hours=4), 2.0, None)]
    out = WX.upsample(spark.createDataFrame(rows, WIDE), 30).orderBy("timestamp_utc").collect()
    assert [(r.wind, r.temp) for r in out] == [(1.0, None)] * 6 + [(1.0, 7.0)] * 2 + [(2.0, 7.0)]


def test_upsample_leaves_coarser_targets_and_empty_tables_alone(spark):
    df = hours(spark, 3)
    assert WX.upsample(df, 60) is df and WX.upsample(df, 120) is df
    assert WX.upsample(df.limit(0), 10).count() == 0


@pytest.mark.parametrize("minutes,n", [(10, 30), (60, 24)])
def test_horizon_join_reads_the_weather_of_the_target_time(spark, minutes, n):
    obs = spark.createDataFrame(
        [(START + timedelta(minutes=minutes * i), float(i)) for i in range(n)], "timestamp_utc timestamp, y double")
    out = WX.join_horizons(obs, hours(spark, 6), [1, 6], minutes, ["wind"]).orderBy("timestamp_utc").collect()
    assert len(out) == n
    for i, r in enumerate(out):
        for h in (1, 6):
            at = (i + h) * minutes
            want = 10 + (at // 60) / 2 if at <= 5 * 60 else None
            assert r[f"nwp_wind_h{h}"] == want
    assert "nwp_temp_h1" not in out[0].asDict()


def test_horizon_join_without_variables_changes_nothing(spark):
    obs = hours(spark, 2)
    assert WX.join_horizons(obs, hours(spark, 2).select("timestamp_utc"), [1], 60) is obs


def test_horizon_join_is_one_join(spark):
    obs = spark.range(10).select((F.lit(START) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp_utc"))
    plan = WX.join_horizons(obs, hours(spark, 6), [1, 6, 12, 24, 48], 60)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_weighted_mean_renormalises_over_present_values(spark):
    long = spark.createDataFrame(
        [("a", START, "t", 10.0), ("b", START, "t", 20.0), ("a", START, "w", None), ("b", START, "w", 4.0),
         ("a", START, "x", None), ("c", START, "t", 1e9)],
        "location_key string, timestamp_utc timestamp, variable string, value double")
    points = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "location_key string, weight double")
    out = {r.variable: r.value for r in WX.weighted_mean(long, points).collect()}
    assert out == {"t": 17.5, "w": 4.0, "x": None}


def test_site_weather_uses_configured_points(spark):
    site = WX.weather_site("rte_france")
    rows = [(f"{lat}_{lon}", START, "temperature_2m", 10.0 + i) for i, (_, lat, lon, _) in enumerate(site.points)]
    long = spark.createDataFrame(rows, "location_key string, timestamp_utc timestamp, variable string, value double")
    want = sum((10.0 + i) * p[3] for i, p in enumerate(site.points))
    row = WX.site_weather(long, site).first()
    assert row.temperature_2m == pytest.approx(want) and row.wind_speed_10m is None


def test_sites_are_checked():
    with pytest.raises(ValueError, match="sum to 1"):
        WX.WeatherSite("x", ("t",), (("p", 0.0, 0.0, 0.5),))
    with pytest.raises(ValueError, match="unknown weather site"):
        WX.weather_site("mars")


def test_blend(spark):
    a = hours(spark, 6, temp=lambda h: 1.0)
    b = hours(spark, 6, temp=lambda h: 2.0).drop("wind")
    out = WX.blend(a, b, "2023-01-01 03:00:00").orderBy("timestamp_utc").collect()
    assert [r.temp for r in out] == [1.0] * 3 + [2.0] * 3 and out[0].asDict().keys() == {"timestamp_utc", "temp"}
    assert WX.blend(a, None, "2023-01-01") is a and WX.blend(None, b, "2023-01-01") is b
    assert WX.blend(None, None, "2023-01-01") is None
    with pytest.raises(ValueError):
        WX.blend(a, None, "2023-01-01", strict=True)


def test_clamp_and_forecast_start(spark):
    d = lambda text: F.lit(text).cast("date")
    row = spark.range(1).select(
        WX.clamp_end(d("2024-05-10"), d("2024-05-12")).alias("late"),
        WX.clamp_end(d("2024-05-01"), d("2024-05-12")).alias("early"),
        WX.require_forecast_start(d("2022-01-01")).alias("ok")).first()
    assert (row.late, row.early, row.ok) == (date(2024, 5, 7), date(2024, 5, 1), date(2022, 1, 1))
    with pytest.raises(Exception, match="forecast archive starts"):
        spark.range(1).select(WX.require_forecast_start(d("2021-12-31"))).collect()


def test_missing_ranges_share_the_boundary_day(spark):
    covered = spark.createDataFrame(
        [("a", datetime(2023, 1, 5), datetime(2023, 1, 9, 23))],
        "location_key string, first_ts timestamp, last_ts timestamp")
    asked = spark.createDataFrame(
        [("a", date(2023, 1, 1), date(2023, 1, 12)), ("a", date(2023, 1, 6), date(2023, 1, 8)),
         ("b", date(2023, 1, 1), date(2023, 1, 2))],
        "location_key string, start_date date, end_date date")
    out = {tuple(r) for r in WX.missing_ranges(asked, covered).collect()}
    assert out == {
        ("a", "before", date(2023, 1, 1), date(2023, 1, 5)), ("a", "after", date(2023, 1, 9), date(2023, 1, 12)),
        ("b", "all", date(2023, 1, 1), date(2023, 1, 2))}


def test_store_round_trip(spark):
    path = work_path(spark, "store")
    assert read_store(spark, path).count() == 0

    def batch(location, n, add=0.0):
        return hours(spark, n, wind=lambda h: h + add, temp=lambda h: None if h == 1 else h + add).withColumn(
            "location_key", F.lit(location))

    assert upsert(spark, path, batch("a", 4)) == 8
    assert upsert(spark, path, batch("b", 2)) == 4
    assert upsert(spark, path, batch("a", 4)) == 8
    assert read_store(spark, path).count() == 12
    assert upsert(spark, path, batch("a", 2, add=100.0)) == 4
    got = WX.query_long(read_store(spark, path), "a", "2023-01-01", "2023-01-01", ["wind", "temp"])
    assert [(r.wind, r.temp) for r in got.orderBy("timestamp_utc").collect()] == [
        (100.0, 100.0), (101.0, None), (2.0, 2.0), (3.0, 3.0)]
    cover = {r.location_key: (r.first_ts, r.last_ts) for r in WX.coverage(read_store(spark, path)).collect()}
    assert cover == {"a": (START, START + timedelta(hours=3)), "b": (START, START + timedelta(hours=1))}


def test_query_end_day_is_included(spark):
    long = WX.to_long(hours(spark, 72).withColumn("location_key", F.lit("a")))
    out = WX.query_long(long, "a", "2023-01-02", "2023-01-02", ["wind"])
    assert out.count() == 24 and out.columns == ["timestamp_utc", "wind"]
    assert WX.query_long(long, "nowhere", "2023-01-02", "2023-01-02", ["wind"]).count() == 0


def test_hourly_grid_excludes_the_end(spark):
    df = spark.createDataFrame(
        [("a", START, START + timedelta(hours=3), 3600, [1.0, 2.0, 3.0])],
        "location_key string, start timestamp, end timestamp, step_seconds int, values array<double>")
    out = WX.hourly_grid(df).orderBy("timestamp_utc").collect()
    assert [(r.timestamp_utc.hour, r.value) for r in out] == [(0, 1.0), (1, 2.0), (2, 3.0)]


def _month_files(path):
    return {p.relative_to(path / "data").as_posix() for p in (path / "data").rglob("*.parquet")}


def _wind(spark, rows):
    return spark.createDataFrame(rows, "location_key string, timestamp_utc timestamp, wind double")


def test_upsert_leaves_other_months_alone(spark, tmp_path):
    path = tmp_path / "store"
    upsert(spark, str(path), _wind(spark, [("a", datetime(2023, m, d, 5), float(m)) for m in (1, 2, 3) for d in (1, 2)]))
    before = _month_files(path)
    old = read_store(spark, str(path))
    upsert(spark, str(path), _wind(spark, [("a", datetime(2023, 2, 1, 5), 9.0)]))
    fresh = _month_files(path) - before
    assert before <= _month_files(path) and len(fresh) == 1 and "month=2023-02" in min(fresh)
    values = sorted(r.value for r in read_store(spark, str(path)).collect())
    assert values == [1.0, 1.0, 2.0, 3.0, 3.0, 9.0]
    # A frame that was read before the upsert still reads what it saw.
    assert sorted(r.value for r in old.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]


@pytest.mark.parametrize("broken", ["_commit", "latest_per_key"])
def test_interrupted_upsert_changes_nothing(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "store")
    upsert(spark, path, _wind(spark, [("a", START, 1.0), ("b", START, 2.0)]))

    def fail(*_):
        assert {r.value for r in read_store(spark, path).collect()} == {1.0, 2.0}
        raise RuntimeError("lost")

    monkeypatch.setattr(weather_store, broken, fail)
    with pytest.raises(RuntimeError, match="lost"):
        upsert(spark, path, _wind(spark, [("a", START, 5.0)]))
    monkeypatch.undo()
    assert {r.value for r in read_store(spark, path).collect()} == {1.0, 2.0}
    upsert(spark, path, _wind(spark, [("a", START, 7.0)]))
    assert {r.value for r in read_store(spark, path).collect()} == {7.0, 2.0}


def test_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    commit = weather_store._commit

    def late(folder, number, snapshot):
        monkeypatch.undo()
        upsert(spark, path, _wind(spark, [("b", START, 2.0)]))
        commit(folder, number, snapshot)

    monkeypatch.setattr(weather_store, "_commit", late)
    with pytest.raises(weather_store.StoreChanged):
        upsert(spark, path, _wind(spark, [("a", START, 1.0)]))
    assert [r.value for r in read_store(spark, path).collect()] == [2.0]


def test_expire_keeps_the_last_state(spark, tmp_path):
    path = tmp_path / "store"
    for value in (1.0, 2.0, 3.0):
        upsert(spark, str(path), _wind(spark, [("a", START, value), ("b", START + timedelta(days=40 * value), value)]))
    (path / "data" / "version=remains").mkdir()
    # The remains, two replaced months and two snapshots.
    assert weather_store.expire(spark, str(path)) == 5
    got = sorted((r.location_key, r.value) for r in read_store(spark, str(path)).collect())
    assert got == [("a", 3.0), ("b", 1.0), ("b", 2.0), ("b", 3.0)]
    upsert(spark, str(path), _wind(spark, [("a", START, 4.0)]))
    # The month that was replaced, inside a version that still holds others, and the snapshot before.
    assert weather_store.expire(spark, str(path)) == 2
    assert sorted(r.value for r in read_store(spark, str(path)).collect()) == [1.0, 2.0, 3.0, 4.0]
    assert read_store(spark, str(path)).where("location_key = 'a'").first().value == 4.0
    assert weather_store.expire(spark, str(tmp_path / "none")) == 0
