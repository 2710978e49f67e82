"""Physical plans: what reaches the scan, and how many shuffles there are."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridwright.operators import features as FT
from gridwright.operators import metrics as M
from gridwright.operators import resample as RS
from gridwright.operators import runs as R
from gridwright.operators import weather as WX
from gridwright.operators import windows as W
from gridwright.session import clear_work, work_path, written
from tests.test_quality import scada


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, ts):
    path = work_path(spark, "plan-scada")
    scada(spark, ts, n=50).write.parquet(path)
    return spark.read.parquet(path)


def test_quality_filter_and_columns_reach_the_scan(stored):
    out = FT.wind_features(stored).select("turbine_id", "active_power_kw_lag1", "wind_dir_sin")
    text = plan(out)
    assert "EqualTo(qc_flag,0)" in text
    schema = text[text.index("ReadSchema"):]
    assert "active_power_kw" in schema and "nacelle_temp_c" not in schema and "status_code" not in schema


def test_features_use_one_shuffle_and_one_window(stored):
    text = plan(FT.wind_features(stored, "full"))
    assert text.count("Exchange") == 1 and text.count("Window [") == 1


def test_exogenous_baseline_needs_no_shuffle(stored):
    assert "Exchange" not in plan(FT.wind_features(stored, "baseline", lags=False, longest=50).select("wind_dir_sin"))


def test_all_metrics_of_all_horizons_share_one_aggregation(stored):
    featured = FT.wind_features(stored)
    targets = W.targets_long(featured, W.Series(("turbine_id",)), "active_power_kw", [1, 6, 12])
    text = plan(M.regression_metrics(targets, "target", "active_power_kw_lag1", ["horizon"]))
    assert text.count("Exchange hashpartitioning(horizon") == 1 and text.count("Scan parquet") == 1


def test_a_small_weather_table_spares_the_observations_a_shuffle(spark, stored):
    weather = stored.select("timestamp_utc", F.col("wind_speed_ms").alias("wind"))
    text = plan(WX.join_horizons(stored, weather, [1, 6], 60))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_a_large_weather_table_is_left_to_the_planner(spark, stored, monkeypatch):
    monkeypatch.setattr(WX, "MAX_BROADCAST_BYTES", 0)
    weather = stored.select("timestamp_utc", F.col("wind_speed_ms").alias("wind"))
    logical = WX.join_horizons(stored, weather, [1, 6], 60)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical


def test_grid_bound_holds(spark, stored):
    weather = stored.select("timestamp_utc", F.col("wind_speed_ms").alias("wind")).where("minute(timestamp_utc) = 0")
    for step in (10, 60):
        rows = WX.horizons_table(weather, [1, 6], step).count()
        assert rows <= WX.most_rows(weather, [1, 6], step)[0]


def test_duplicates_merge_before_the_shuffle(stored):
    text = plan(RS.dedupe_first(stored, ["turbine_id"], [F.col("timestamp_utc")]))
    assert text.count("SortAggregate") == 2 and "Window" not in text


def test_pivots_take_one_aggregation(spark):
    metrics = spark.createDataFrame([("r", "h1_mae", 1.0)], "run_id string, key string, value double")
    runs = spark.createDataFrame([("r", "xgboost", "wind_full")], "run_id string, backend string, feature_set string")
    assert plan(R.runs_pivot(runs, metrics, [1])).count("partial_max") == 3


def test_known_bound_skips_the_count(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("bound", "bound")
    W.add_lags(stored, W.Series(("turbine_id",)), "active_power_kw", [1], longest=50)
    assert list(tracker.getJobIdsForGroup("bound")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_work_tables_can_be_cleared(spark):
    clear_work(spark)
    kept = written(spark.range(5), "kept")
    assert kept.count() == 5
    path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert Path(path).exists()
    assert clear_work(spark) == 1 and not Path(path).exists() and clear_work(spark) == 0


def test_runs_and_generated_metrics_are_not_broadcast(spark):
    """A generator's output counts for the planner as no more than its input."""
    runs = spark.createDataFrame([("r1", "p", "xgboost", "wind_baseline")], "run_id string, parent_run_id string, backend string, feature_set string")
    keys = F.inline(F.array(*[F.struct(F.lit(f"h{h}_mae").alias("key"), F.lit(1.0).alias("value")) for h in range(50)]))
    metrics = runs.select("run_id", keys)
    children = runs.select("run_id", "parent_run_id")
    for out in (R.backfill_curves(children, metrics, 10), R.run_cells(runs, metrics), R.runs_pivot(runs, metrics, [1, 6]), R.runs_pivot(runs, metrics)):
        text = plan(out)
        assert "SortMergeJoin [run_id" in text and "BroadcastExchange" not in text.split("SortMergeJoin [run_id", 1)[1]
