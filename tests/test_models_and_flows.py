import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gridwright.models import direct as D
from gridwright.models import recursive as RC
from gridwright.models.boosting import best_rounds
from gridwright.operators.resample import temporal_split
from gridwright.operators.weather import weather_site
from gridwright.operators.windows import Series
from gridwright.plans import flows
from gridwright.schemas import CANONICAL, to_canonical
from gridwright.session import work_path
from gridwright.sources.weather_store import upsert

QUICK = D.Boosting(rounds=8, rate=0.3, depth=3, patience=3)


@pytest.fixture(scope="module")
def linear(spark):
    return LinearRegression(featuresCol="features", labelCol="target", predictionCol="prediction", regParam=0.01)


@pytest.fixture(scope="module")
def load(spark):
    """Two zones, one reading every tenth day at varying hours, for eight years."""
    t0, rng = datetime(2014, 1, 1), np.random.default_rng(5)
    rows = []
    for zone in ("N", "S"):
        for i in range(300):
            rows.append((t0 + timedelta(days=10 * i, hours=i % 24), "x", zone,
                         float(50_000 + 9_000 * math.sin(i / 5) + rng.normal(0, 300)), float(i)))
    df = spark.createDataFrame(
        rows, "timestamp_utc timestamp, dataset_id string, zone_id string, load_mw double, load_mw_lag1 double")
    lagged = df.withColumn("load_mw_lag1", F.col("load_mw") + 100).withColumn(
        "nwp_t_h1", F.sin(F.col("load_mw") / 9000)).withColumn("nwp_t_h2", F.cos(F.col("load_mw") / 9000))
    return temporal_split(lagged, 5, 1)


@pytest.fixture(scope="module")
def table(load):
    return D.targets_table(load, Series(("zone_id",)), "load_mw", [1, 2])


def test_one_model_per_horizon_and_the_metrics_of_each(table):
    names = ["load_mw_lag1", "nwp_t", "absent"]
    models = D.train_horizons(table, names, [1, 2], QUICK)
    assert sorted(models) == [1, 2]
    assert all(1 <= len(m.trees) <= 8 and m.features == ["load_mw_lag1", "nwp_t"] for m in models.values())
    predictions = D.predict_horizons(models, table, names, keep=["load_mw_lag1"])
    out = {(r.horizon, r.split): r for r in D.evaluate_horizons(predictions, "load_mw_lag1").collect()}
    assert set(out) == {(h, s) for h in (1, 2) for s in ("val", "test")}
    for r in out.values():
        assert r.mae > 0 and r.skill_score == pytest.approx(1 - r.rmse / r.persistence_rmse)
    pdf = predictions.where("horizon = 2 and split = 'val'").toPandas()
    assert out[2, "val"].mae == pytest.approx((pdf.prediction - pdf.target).abs().mean())
    assert out[2, "val"].n_rows == len(pdf)


def test_leaderboard_ranks_by_validation_error_only(table, linear):
    board = D.model_leaderboard(table, ["load_mw_lag1"], 1, D.default_candidates(depth=2, trees=3)).orderBy("rank").collect()
    assert [r.rank for r in board] == [1, 2, 3, 4]
    assert [r.mae for r in board] == sorted(r.mae for r in board)
    assert {r.model for r in board} == {"linear", "tree", "forest", "boosted"}
    # Spoiling validation and test labels must not change any fitted model: ranks use them, fits do not.
    moved = table.withColumn("target_h1", F.when(F.col("split") == "val", F.col("target_h1") + 5).otherwise(F.col("target_h1")))
    a = D.model_leaderboard(table, ["load_mw_lag1"], 1, {"linear": linear}).first()
    b = D.model_leaderboard(moved, ["load_mw_lag1"], 1, {"linear": linear}).first()
    assert b.rmse != a.rmse and abs(b.mae - a.mae) <= 5.0 + 1e-9


@pytest.fixture(scope="module")
def series(spark):
    t0, rng = datetime(2024, 1, 1), np.random.default_rng(3)
    rows = []
    for name, n in (("a", 120), ("b", 90), ("tiny", 10)):
        y = np.cumsum(rng.normal(0, 1, n)) + 50
        rows += [(name, t0 + timedelta(minutes=10 * i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "unique_id string, ds timestamp, y double")


def test_best_rounds_waits_for_its_patience():
    errors = [5.0, 4.0, 4.5, 3.0, 3.5, 3.6, 3.7, 2.0]
    assert best_rounds(errors, 2) == (4, True)
    assert best_rounds(errors, 4) == (8, False)
    assert best_rounds([1.0, 2.0, 3.0], 2) == (1, True)
    assert best_rounds([3.0, 2.0, 1.0], 2) == (3, False)


def test_recursive_forecast_equals_a_plain_loop(series, linear):
    model = RC.fit_one_step(series, "wind", linear)
    out = RC.recursive_forecast(series, model, "wind", 15).toPandas()
    names, fitted = RC.lag_feature_names(RC.DOMAINS["wind"]), model.stages[-1]
    assert set(out.unique_id) == {"a", "b"} and len(out) == 30
    for key in ("a", "b"):
        past = series.where(F.col("unique_id") == key).toPandas().sort_values("ds")
        values = list(past.y)
        for _ in range(15):
            x = {f"y_lag{k}": values[-k] for k in (1, 2, 3, 6, 12, 24)}
            for w in (6, 12, 24):
                x[f"y_roll_mean_{w}"], x[f"y_roll_std_{w}"] = np.mean(values[-w:]), np.std(values[-w:], ddof=1)
            values.append(fitted.intercept + float(np.dot(fitted.coefficients.toArray(), [x[n] for n in names])))
        got = out[out.unique_id == key].sort_values("ds")
        assert np.allclose(got.prediction, values[-15:], rtol=1e-9)
        assert got.ds.iloc[0] == past.ds.iloc[-1] + pd.Timedelta(minutes=10)


@pytest.fixture(scope="module")
def with_hour(series):
    return series.withColumn("hour", F.hour("ds").cast("double")).withColumn("wave", F.sin(F.minute("ds") / 7.0))


def _future(frame, steps, shift=0):
    step = F.expr("interval '10' minute")
    ends = frame.groupBy("unique_id").agg(F.max("ds").alias("e"))
    times = ends.select("unique_id", F.explode(F.sequence(F.col("e") + (1 + shift) * step, F.col("e") + (steps + shift) * step, step)).alias("ds"))
    return times.withColumn("hour", F.hour("ds").cast("double")).withColumn("wave", F.sin(F.minute("ds") / 7.0))


def _plain_forecast(frame, key, steps, predict):
    past = frame.where(F.col("unique_id") == key).toPandas().sort_values("ds")
    values, last = list(past.y), past.ds.iloc[-1]
    for k in range(1, steps + 1):
        at = last + pd.Timedelta(minutes=10 * k)
        x = {f"y_lag{n}": values[-n] for n in (1, 2, 3, 6, 12, 24)} | {"hour": float(at.hour), "wave": math.sin(at.minute / 7.0)}
        for w in (6, 12, 24):
            x[f"y_roll_mean_{w}"], x[f"y_roll_std_{w}"] = np.mean(values[-w:]), np.std(values[-w:], ddof=1)
        values.append(predict(x))
    return values[-steps:]


def test_future_covariates_are_fed_step_by_step(with_hour, linear):
    outside = ["hour", "wave"]
    model = RC.fit_one_step(with_hour, "wind", linear, exogenous=outside)
    out = RC.recursive_forecast(with_hour, model, "wind", 15, future=_future(with_hour, 20), exogenous=outside).toPandas()
    names, fitted = [*RC.lag_feature_names(RC.DOMAINS["wind"]), *outside], model.stages[-1]
    for key in ("a", "b"):
        want = _plain_forecast(with_hour, key, 15, lambda x: fitted.intercept + float(np.dot(fitted.coefficients.toArray(), [x[n] for n in names])))
        assert np.allclose(out[out.unique_id == key].sort_values("ds").prediction, want, rtol=1e-9)
    assert len(out) == 30


def test_one_fold_and_a_plan_per_step_agree(with_hour, linear, monkeypatch):
    outside = ["hour"]
    model = RC.fit_one_step(with_hour, "wind", linear, exogenous=outside, features=["y_lag1", "y_roll_std_6"])
    given = dict(future=_future(with_hour, 14), exogenous=outside)
    folded = RC.recursive_forecast(with_hour, model, "wind", 14, **given).orderBy("unique_id", "ds").collect()
    monkeypatch.setattr(RC, "_linear", lambda _: None)
    stepped = RC.recursive_forecast(with_hour, model, "wind", 14, **given).orderBy("unique_id", "ds").collect()
    assert [(r.unique_id, r.ds) for r in folded] == [(r.unique_id, r.ds) for r in stepped] and len(folded) == 28
    assert np.allclose([r.prediction for r in folded], [r.prediction for r in stepped], rtol=1e-9)


def test_series_without_whole_future_have_no_forecast(with_hour, linear):
    model = RC.fit_one_step(with_hour, "wind", linear, exogenous=["hour"])
    whole = _future(with_hour, 6)
    for future in (whole.where("unique_id = 'a' or minute(ds) <> 0"), whole.withColumn("hour", F.when(F.col("unique_id") == "a", F.col("hour"))),
                   whole.where("unique_id = 'a'").unionByName(_future(with_hour, 6, 1).where("unique_id = 'b'")),
                   whole.unionByName(whole.where("unique_id = 'b'"))):
        out = RC.recursive_forecast(with_hour, model, "wind", 6, future=future, exogenous=["hour"])
        assert [(r.unique_id, r["count"]) for r in out.groupBy("unique_id").count().collect()] == [("a", 6)]
    with pytest.raises(ValueError, match="future values of hour"):
        RC.recursive_forecast(with_hour, model, "wind", 6, exogenous=["hour"])


def test_fold_sums_give_the_fits_of_cross_validation(with_hour):
    plain = LinearRegression(featuresCol="features", labelCol="target", predictionCol="prediction", solver="normal")
    for outside in ([], ["hour", "wave"]):
        want = RC.cross_validate(with_hour, "wind", plain, [1, 3], 3, exogenous=outside).toPandas()
        got = RC.cross_validate_linear(with_hour, "wind", [1, 3], 3, exogenous=outside).toPandas()
        keys = ["unique_id", "cutoff", "horizon"]
        want, got = want.sort_values(keys).reset_index(drop=True), got.sort_values(keys).reset_index(drop=True)
        assert len(got) == 2 * 3 * 2 and list(got.columns) == list(want.columns)
        assert (got[[*keys, "ds"]] == want[[*keys, "ds"]]).all().all() and np.allclose(got.y, want.y)
        assert np.allclose(got.prediction, want.prediction, rtol=1e-6)


def test_folds_start_from_the_last_row_before_their_cutoff(spark):
    t0, rng = datetime(2024, 1, 1), np.random.default_rng(8)
    times = np.cumsum(rng.choice([4, 10, 10, 25], 200))
    rows = [("a", t0 + timedelta(minutes=int(m)), float(v)) for m, v in zip(times, rng.normal(size=200))]
    frame = spark.createDataFrame(rows, "unique_id string, ds timestamp, y double")
    out = RC.cross_validate_linear(frame, "wind", [2, 5], 2, features=["y_lag1"]).collect()
    ds = [r[1] for r in rows]
    for r in out:
        origin = max(i for i, d in enumerate(ds) if d <= r.cutoff)
        assert r.ds == ds[origin] + timedelta(minutes=10 * r.horizon) and r.y == rows[origin + r.horizon][2]
        known = [i for i in range(24, 200 - r.horizon) if ds[i] + timedelta(minutes=10 * r.horizon) <= r.cutoff]
        b, a = np.polyfit([rows[i - 1][2] for i in known], [rows[i + r.horizon][2] for i in known], 1)
        assert r.prediction == pytest.approx(a + b * rows[origin - 1][2])
    assert len(out) == 4


def test_least_squares_of_constant_and_single_columns():
    x = np.array([[1.0, 2.0, 7.0, 3.0], [1.0, 4.0, 7.0, 7.0], [1.0, 5.0, 7.0, 9.0]])
    start, weights = RC.least_squares_of(x.T @ x)
    assert start == pytest.approx(-1) and weights == pytest.approx([2, 0])


def test_history_is_limited_before_the_shuffle(series):
    plan = RC.recent_history(series, Series(("unique_id",), "ds"), "y", 24)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert partial > 0


def test_cross_validation_predicts_after_each_cutoff(series, linear):
    out = RC.cross_validate(series, "wind", linear, [1, 6], n_windows=2).toPandas()
    assert set(out.unique_id) == {"a", "b"} and len(out) == 2 * 2 * 2
    actual = series.toPandas().set_index(["unique_id", "ds"]).y
    for r in out.itertuples():
        assert r.ds == r.cutoff + pd.Timedelta(minutes=10 * r.horizon)
        assert r.y == actual[r.unique_id, r.ds]
    ends = series.groupBy("unique_id").agg(F.max("ds").alias("e")).toPandas().set_index("unique_id").e
    assert {(ends[r.unique_id] - r.cutoff) for r in out.itertuples()} == {pd.Timedelta(hours=1), pd.Timedelta(hours=2)}


def test_persistence_folds_use_the_last_value_before_the_cutoff(series):
    out = RC.persistence_folds(series, "wind", 6, 3).toPandas()
    all_rows = series.toPandas()
    for r in out.itertuples():
        past = all_rows[(all_rows.unique_id == r.unique_id) & (all_rows.ds <= r.cutoff)].sort_values("ds")
        assert (np.isnan(r.prediction) and past.empty) or r.prediction == past.y.iloc[-1]
    assert len(out) == 18 + 18 + 10


def test_wind_flow_end_to_end(spark):
    """Three years of six-hourly readings: flags, features, split, models, metrics."""
    t0, rng = datetime(2018, 1, 1), np.random.default_rng(9)
    rows = []
    for turbine in ("KWF1", "KWF2"):
        for i in range(900):
            wind = float(8 + 4 * math.sin(i / 9) + rng.normal(0, 0.5))
            rows.append((t0 + timedelta(hours=30 * i), "kelmarsh", turbine, max(0.0, wind) * 120, wind, float(i % 360), 2.0 + i / 1e4,
                         10.0, 180.0, 9.0, 20.0, 0, False, False, 0))
    raw = spark.createDataFrame(rows, CANONICAL["wind"])
    flagged_path, feature_path = work_path(spark, "flagged"), work_path(spark, "features")
    summary = flows.flag_table(raw, "kelmarsh", flagged_path).first()
    assert summary.total_rows == 1800 and summary.qc_ok > 1700
    built = flows.feature_table(spark.read.parquet(flagged_path), "wind", "enriched", feature_path)
    assert 1500 < built.count() < 1800
    out = flows.train_and_evaluate(built, "wind", "wind_enriched", 1, 1, [1, 6], QUICK)
    got = {(r.horizon, r.split): r for r in out.collect()}
    assert set(got) == {(1, "val"), (1, "test"), (6, "val"), (6, "test")}
    assert got[1, "val"].skill_score > 0


def test_flow_refuses_other_tables(spark):
    with pytest.raises(ValueError, match="not a canonical wind table"):
        flows.flag_table(spark.range(1), "kelmarsh", "unused")


def test_demand_and_solar_flows(spark, load):
    flagged = work_path(spark, "flagged-load")
    raw = to_canonical(load.select("timestamp_utc", "dataset_id", "zone_id", "load_mw"), "demand")
    assert flows.flag_table(raw, "rte_france", flagged).first().total_rows == 600
    built = flows.feature_table(spark.read.parquet(flagged), "demand", "enriched", work_path(spark, "f"))
    assert built.count() == 2 * (300 - 168)


def test_weather_flows(spark):
    store, other = work_path(spark, "w1"), work_path(spark, "w2")
    site = weather_site("spain_demand")
    calls = []

    def fetch(key, lat, lon, first, last, variables):
        calls.append((key, first, last))
        hours = int((last - first).days + 1) * 24
        start = datetime(first.year, first.month, first.day)
        return spark.createDataFrame(
            [(key, start + timedelta(hours=h), float(h), 2.0, 3.0) for h in range(hours)],
            f"location_key string, timestamp_utc timestamp, {', '.join(f'{v} double' for v in variables)}")

    assert flows.stored_weather(spark, store, "spain_demand") is None
    assert flows.fetched_weather(spark, store, "spain_demand", "2023-01-02", "2023-01-03", fetch).count() == 48
    assert flows.fetched_weather(spark, store, "spain_demand", "2023-01-02", "2023-01-03", fetch).count() == 48
    assert len(calls) == 1
    assert flows.fetched_weather(spark, store, "spain_demand", "2023-01-01", "2023-01-03", fetch).count() == 72
    assert [str(c[1]) for c in calls] == ["2023-01-02", "2023-01-01"] and str(calls[1][2]) == "2023-01-02"
    assert flows.blended_weather(spark, store, other, "spain_demand").count() == 72
    later = fetch("40.4168_-3.7038", 0, 0, datetime(2023, 1, 3).date(), datetime(2023, 1, 4).date(), site.variables)
    upsert(spark, other, later)
    both = flows.blended_weather(spark, store, other, "spain_demand", "2023-01-03 12:00:00").orderBy("timestamp_utc").collect()
    assert len(both) == 96 and both[60].temperature_2m == 12.0
