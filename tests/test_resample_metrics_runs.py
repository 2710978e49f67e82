import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridwright.operators import metrics as M
from gridwright.operators import resample as RS
from gridwright.operators import runs as R
from gridwright.operators.metric_states import Mean, QuantileOf, merged_metrics, pinball
from gridwright.operators.windows import Series
from gridwright.schemas import CANONICAL, empty_frame, schema_errors, to_canonical, validate_schema


def test_schema_report(spark):
    assert schema_errors(empty_frame(spark, "wind"), "wind", strict=True) == []
    bad = empty_frame(spark, "solar").drop("power_kw").withColumn("x", F.lit(1)).withColumn("qc_flag", F.lit(1))
    assert schema_errors(bad, "solar") == [("power_kw", "missing"), ("qc_flag", "expected tinyint, got int")]
    assert ("x", "unexpected") in schema_errors(bad, "solar", strict=True)
    assert validate_schema(bad, "solar").count() == 2
    assert {d: len(s) for d, s in CANONICAL.items()} == {"wind": 15, "demand": 12, "solar": 10}
    assert to_canonical(spark.range(1).select(F.lit("2").alias("load_mw")), "demand").first().load_mw == 2.0


def test_buckets_start_on_the_quarter_hour(spark):
    t0 = datetime(2020, 6, 15, 6)
    df = spark.createDataFrame(
        [(t0 + timedelta(minutes=m, seconds=30), float(m) if m % 2 else None) for m in range(31)],
        "timestamp_utc timestamp, v double")
    out = RS.bucket_mean(df, 15, ["v"]).orderBy("timestamp_utc").collect()
    assert [(r.timestamp_utc.minute, r.v) for r in out] == [(0, 7.0), (15, 22.0), (30, None)]
    assert [r.timestamp_utc.hour for r in RS.bucket_mean(df, 60, ["v"]).collect()] == [6]


def test_dedupe_takes_the_first_in_the_given_order(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, None), ("a", 3, 9), ("b", 1, 5)], "k string, n int, v int")
    out = {tuple(r) for r in RS.dedupe_first(df, ["k"], [F.col("n")]).collect()}
    assert out == {("a", 1, None), ("b", 1, 5)}


@pytest.mark.parametrize("start", [datetime(2014, 1, 1), datetime(2016, 2, 29, 6)])
def test_split_is_complete_and_ordered(spark, start):
    df = spark.createDataFrame([(start + timedelta(days=10 * i),) for i in range(300)], "timestamp_utc timestamp")
    out = RS.temporal_split(df, 5, 1)
    stats = {r.split: r for r in RS.split_stats(out).collect()}
    assert sum(r.n_rows for r in stats.values()) == 300 and set(stats) == {"train", "val", "test"}
    assert stats["train"].last_ts < stats["val"].first_ts <= stats["val"].last_ts < stats["test"].first_ts
    day = min(start.day, 28) if start.month == 2 else start.day
    assert stats["train"].last_ts < start.replace(year=start.year + 5, day=day) <= stats["val"].first_ts


def test_folds_are_disjoint_and_count_back_from_each_series_end(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0 + timedelta(hours=h), float(h)) for h in range(30)] + [
        ("b", t0 + timedelta(hours=h), float(h)) for h in range(10)]
    df = spark.createDataFrame(rows, "unique_id string, ds timestamp, y double")
    out = RS.rolling_origins(df, Series(("unique_id",), "ds"), 6, 60, 3).collect()
    a = [(r.fold, r.y) for r in sorted(out, key=lambda r: r.ds) if r.unique_id == "a"]
    assert a == [(f, float(12 + 6 * f + i)) for f in range(3) for i in range(6)]
    assert all(r.cutoff < r.ds <= r.cutoff + timedelta(hours=6) for r in out)
    assert len([r for r in out if r.unique_id == "b"]) == 10


@pytest.fixture(scope="module")
def errors(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(100, 20, 500)
    p, last = y + rng.normal(2, 5, 500), y + rng.normal(0, 10, 500)
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist(), last.tolist())), "y double, p double, last double")
    return df, y, p, last


def test_metrics_equal_numpy(errors):
    df, y, p, last = errors
    row = M.regression_metrics(df, "y", "p", persistence="last").first()
    rmse = np.sqrt(np.mean((p - y) ** 2))
    assert row.mae == pytest.approx(np.mean(np.abs(p - y)))
    assert row.rmse == pytest.approx(rmse) and row.bias == pytest.approx(np.mean(p - y))
    assert row.mape == pytest.approx(np.mean(np.abs((p - y) / y)))
    assert row.skill_score == pytest.approx(1 - rmse / np.sqrt(np.mean((last - y) ** 2)))


@pytest.mark.parametrize("p,last,want", [(1.0, 1.0, 1.0), (2.0, 1.0, -math.inf), (1.5, 2.0, 0.5)])
def test_skill_edges(spark, p, last, want):
    df = spark.createDataFrame([(1.0, p, last)], "y double, p double, l double")
    assert M.regression_metrics(df, "y", "p", persistence="l").first().skill_score == want


def test_mape_is_undefined_with_a_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert M.regression_metrics(df, "y", "p").first().mape is None


def test_regimes(spark):
    df = spark.createDataFrame(
        [(w, 1.0, 2.0) for w in (2.0, 4.99, 5.0, 12.0, 12.01, None)], "w double, y double, p double")
    out = {r.regime: r.n_samples for r in M.regime_metrics(df, "y", "p", M.wind_regime(F.col("w"))).collect()}
    assert out == {"low": 2, "medium": 2, "high": 1}
    poa = spark.createDataFrame([(x, 1.0, 1.0) for x in (-1.0, 0.0, 199.9, 200.0, 600.0)], "w double, y double, p double")
    out = {r.regime: r.n_samples for r in M.regime_metrics(poa, "y", "p", M.solar_regime(F.col("w"))).collect()}
    assert out == {"low_irradiance": 2, "medium_irradiance": 1, "high_irradiance": 1}
    day = spark.createDataFrame([(datetime(2024, 1, 1, h), 1.0, 1.0) for h in range(24)], "w timestamp, y double, p double")
    out = {r.regime: r.n_samples for r in M.regime_metrics(day, "y", "p", M.demand_regime(F.col("w"))).collect()}
    assert out == {"off_peak": 8, "shoulder": 10, "peak": 6}


def test_custom_metrics(errors):
    df, y, p, _ = errors
    built = M.custom_metrics(df, "y", "p", {"worst": lambda a, b: F.max(F.abs(a - b))}).first()
    plain = M.custom_metrics_additive(df, "y", "p", {"sq": lambda a, b: (a - b) ** 2}).first()
    assert built.worst == pytest.approx(np.max(np.abs(p - y)))
    assert plain.sq == pytest.approx(np.mean((p - y) ** 2))


def test_curves_and_keys(spark):
    wide = spark.createDataFrame(
        [("r", 6, 1.0, None, 3.0), ("r", 1, 2.0, 4.0, 5.0)], "run string, horizon int, mae double, mape double, odd double")
    out = {tuple(r) for r in M.metrics_long(wide, 10, ["run"]).collect()}
    assert out == {("r", 60, "mae_by_horizon_min", 1.0), ("r", 10, "mae_by_horizon_min", 2.0),
                   ("r", 10, "mape_by_horizon_min", 4.0)}
    keys = {r.key: r.value for r in M.metrics_prefixed(wide, ["run"]).collect()}
    assert keys == {"h6_mae": 1.0, "h1_mae": 2.0, "h1_mape": 4.0, "h6_odd": 3.0, "h1_odd": 5.0}


@pytest.fixture(scope="module")
def runs(spark):
    t = datetime(2026, 4, 9)
    rows = [
        ("r1", None, "parent", "autogluon", "wind_full", "wind", "CLEAN", t + timedelta(hours=1)),
        ("r2", None, "parent", "xgboost", "wind_baseline", "wind", "LEAKED", t + timedelta(hours=24)),
        ("r3", "r1", "child", None, None, "wind", "CLEAN", t + timedelta(hours=48)),
        ("r4", None, "parent", "xgboost", "demand_baseline", "demand", "CLEAN", t + timedelta(hours=23)),
    ]
    return spark.createDataFrame(
        rows, "run_id string, parent_run_id string, run_type string, backend string, feature_set string, "
        "domain string, data_quality string, start_time timestamp")


@pytest.fixture(scope="module")
def cells(spark, runs):
    rows = [("r1", "h1_mae", 8.0), ("r1", "h1_rmse", 9.0), ("r2", "h1_mae", 10.0), ("r2", "h1_rmse", 12.0),
            ("r1", "h6_mae", 15.0), ("r2", "h6_mae", 20.0), ("r1", "h12_mae", 3.0), ("r2", "h12_mae", 0.0),
            ("r4", "h6_skill_score", 0.25), ("r4", "h1_bias", 1.0)]
    return R.run_cells(runs, spark.createDataFrame(rows, "run_id string, key string, value double"))


def test_skill_vs_baseline(cells):
    out = {(r.run_id, r.horizon): r.skill_vs_baseline for r in R.skill_vs_baseline(cells).collect()}
    assert out[("r1", 1)] == pytest.approx(0.25)      # RMSE, as the baseline has it
    assert out[("r1", 6)] == pytest.approx(0.25)      # MAE otherwise
    assert out[("r1", 12)] is None                    # baseline error zero
    assert out[("r2", 1)] == 0.0 and out[("r4", 6)] is None


def test_comparison_table(cells):
    out = {(r.run_id, r.horizon): r for r in R.comparison_table(R.skill_vs_baseline(cells)).collect()}
    assert (out[("r1", 1)].label, out[("r1", 1)].mae, out[("r1", 1)].skill_vs_baseline) == (
        "autogluon/wind_full", "8", "+0.250")
    assert (out[("r4", 6)].mae, out[("r4", 6)].skill) == ("—", "0.250")


def test_half_way_cells_take_the_even_text(spark):
    cells = spark.createDataFrame(
        [("a", "x", 1, 74.5, 0.0625), ("b", "x", 1, 75.5, -0.0375), ("c", "x", 1, 0.5, -0.0002)],
        "run_id string, label string, horizon int, mae double, skill_score double")
    out = {r.run_id: (r.mae, r.skill) for r in R.comparison_table(cells).collect()}
    assert out == {"a": ("74", "0.062"), "b": ("76", "-0.038"), "c": ("0", "-0.000")}


def test_pivot_and_report_find_their_horizons(spark, runs):
    rows = [("r1", "h1_mae", 8.0), ("r1", "h1_mae", 7.0), ("r1", "h1_rmse", 9.0), ("r2", "h1_mae", 10.0), ("r2", "h1_rmse", 12.0),
            ("r1", "h6_mae", 15.0), ("r2", "h6_mae", 20.0), ("r1", "h48_skill_score", 0.0625), ("r4", "h100_bias", 1.0), ("r4", "odd", 2.0)]
    metrics = spark.createDataFrame(rows, "run_id string, key string, value double")
    wide = R.runs_pivot(runs, metrics)
    assert [c for c in wide.columns if c.startswith("h")] == [f"h{h}_{m}" for m in ("mae", "rmse", "skill_score") for h in (1, 6, 48)]
    out = {r.run_id: r for r in wide.collect()}
    assert set(out) == {"r1", "r2", "r3", "r4"} and (out["r1"].h1_mae, out["r1"].h6_mae, out["r4"].h1_mae) == (8.0, 15.0, None)
    given = {r.run_id: r.asDict() for r in R.runs_pivot(runs, metrics, [1, 6, 48]).collect()}
    assert given == {k: r.asDict() for k, r in out.items()}
    report = {r.run_id: r for r in R.comparison_report(runs, metrics).collect()}
    first = report["r1"]
    assert (first.label, first.h1_mae, first.h1_skill, first.h1_skill_vs_baseline) == ("autogluon/wind_full", "8", "—", "+0.250")
    assert (first.h6_skill_vs_baseline, first.h48_mae, first.h48_skill, first.h48_skill_vs_baseline) == ("+0.250", "—", "0.062", "—")
    assert (report["r2"].h1_skill_vs_baseline, report["r3"].h6_mae) == ("+0.000", "—") and len(report) == 4


def test_report_without_any_metric_or_baseline(spark, runs):
    empty = spark.createDataFrame([], "run_id string, key string, value double")
    assert R.runs_pivot(runs, empty).count() == 4
    assert R.comparison_report(runs, empty).columns == ["run_id", "label"]
    other = spark.createDataFrame([("r1", "h1_mae", 1.0)], "run_id string, key string, value double")
    assert {r.h1_skill_vs_baseline for r in R.comparison_report(runs, other).collect()} == {"—"}


def test_runs_pivot_order(spark, runs):
    metrics = spark.createDataFrame([("r1", "h1_mae", 8.0)], "run_id string, key string, value double")
    out = R.report_order(R.runs_pivot(runs, metrics, [1])).collect()
    assert [r.run_id for r in out] == ["r2", "r4", "r1", "r3"]
    assert out[2].h1_mae == 8.0 and out[0].h1_mae is None and out[3].label == "?/?"


def test_run_filters(runs):
    assert {r.run_id for r in R.parent_runs(runs).collect()} == {"r1", "r4"}
    assert R.parent_runs(runs, None).count() == 3
    assert R.latest_run(runs).first().run_id == "r2"
    assert R.latest_run(runs.where("parent_run_id IS NOT NULL")).first().run_id == "r3"
    assert R.dominant(runs, "domain").first().domain == "wind"
    tags = {r.run_id: (r.generation, r.data_quality) for r in R.classify_lineage(
        runs.drop("data_quality")).collect()}
    assert tags == {"r1": ("gen1", "LEAKED"), "r2": ("gen2", "LEAKED"), "r3": ("gen3", "CLEAN"), "r4": ("gen2", "LEAKED")}


def test_backfill(spark):
    children = spark.createDataFrame(
        [("c1", "p"), ("c2", "p"), ("c3", "p"), ("c4", "p")], "run_id string, parent_run_id string")
    metrics = spark.createDataFrame([
        ("c1", "h6_mae", 1.0), ("c1", "persistence_mae", 2.0), ("c1", "persistence_mape", 9.0), ("c1", "h6_odd", 3.0),
        ("c2", "h6_mae", 50.0),                         # same horizon, later run
        ("c3", "h1_mae", 4.0), ("c3", "h12_mae", 5.0),  # mixed horizons
        ("c4", "persistence_mae", 7.0),                 # no horizon at all
    ], "run_id string, key string, value double")
    out = {tuple(r) for r in R.backfill_curves(children, metrics, 10).select("run_id", "metric", "step", "value").collect()}
    assert out == {("p", "mae_by_horizon_min", 60, 1.0), ("p", "persistence_mae_by_horizon_min", 60, 2.0)}


def test_champion_is_per_horizon(spark):
    scores = spark.createDataFrame(
        [("a", 1, 2.0), ("b", 1, 2.0), ("a", 6, 9.0), ("b", 6, 3.0), ("c", 6, None)], "model string, horizon int, mae double")
    assert {tuple(r) for r in R.best_model(scores).collect()} == {(1, "a", 2.0), (6, "b", 3.0)}


def _skewed(spark, n=30_000):
    rng = np.random.default_rng(2)
    rows = [("hot" if i % 10 else ["cold", None][i % 3 == 0], float(a), float(b)) for i, (a, b) in enumerate(rng.lognormal(size=(n, 2)))]
    rows += [("gap", None, 1.0), ("gap", 2.0, None), ("one", 3.0, 5.0)]
    return spark.createDataFrame(rows, "k string, y double, p double").repartition(17)


def test_merged_metrics_equal_brute_force(spark):
    df = _skewed(spark)
    metrics = {"median": QuantileOf(lambda y, p: np.abs(p - y), 0.5, 1 << 16), "high": QuantileOf(lambda y, p: p - y, 0.9, 1 << 16),
               "pinball": pinball(0.9), "rows": Mean(lambda y, p: np.ones(len(y)))}
    out = {r.k: r for r in merged_metrics(df, "y", "p", metrics, ["k"], fan_in=3).collect()}
    pdf = df.toPandas().dropna(subset=["y", "p"])
    assert set(out) == {"hot", "cold", "one", None}
    for key, r in out.items():
        part = pdf[pdf.k.isna() if key is None else pdf.k == key]
        e = part.y - part.p
        assert r.median == pytest.approx(np.median(abs(e))) and r.high == pytest.approx(np.quantile(-e, 0.9))
        assert r.pinball == pytest.approx(np.mean(np.maximum(0.9 * e, -0.1 * e))) and r.rows == 1.0
    whole = merged_metrics(df, "y", "p", metrics).collect()
    assert len(whole) == 1 and whole[0].median == pytest.approx(np.median(abs(pdf.y - pdf.p)))
    assert merged_metrics(df.limit(0), "y", "p", metrics, ["k"]).count() == 0


def test_sketch_stays_small_and_near(spark):
    rng = np.random.default_rng(5)
    metric, values = QuantileOf(lambda y, p: y, 0.5, 256), rng.permutation(100_000).astype(float)
    state = metric.start()
    for part in np.array_split(values, 40):
        state = metric.merge(state, metric.update(metric.start(), part, part))
    assert sum(map(len, state.levels)) <= 256 * len(state.levels) and len(state.levels) < 12
    assert sum(len(v) * 2 ** k for k, v in enumerate(state.levels)) == 100_000
    for q in (0.05, 0.5, 0.95):
        got = QuantileOf(metric.value, q, 256).finish(state)
        assert abs(got / 100_000 - q) < 9 / 256
    assert metric.finish(metric.start()) is None
