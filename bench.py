"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridwright.catalog import QUERIES  # noqa: E402
from gridwright.session import clear_work, local_session  # noqa: E402

HEADLINE = [
    "qc_wind", "qc_demand", "qc_solar", "wind_features_full", "demand_features_full", "solar_features_full",
    "lag_features", "rolling_mean", "ffill_limit", "upsample_ffill", "join_nwp_horizons", "weighted_mean_points",
    "resample_mean_15min", "horizon_target", "direct_targets", "persistence_metrics", "regression_metrics",
    "regime_demand", "dedupe_first", "runs_pivot", "skill_vs_baseline", "metrics_backfill", "rolling_origin_folds",
    "ingest_turbine_csv", "ingest_load_tsv", "ingest_pv_csv", "ingest_archives", "weather_upsert", "predict_evaluate",
    "recursive_forecast", "predict_evaluate_boosted", "model_leaderboard_default", "recursive_forecast_full",
    "rolling_origin_fits", "rolling_origin_fits_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # A first small job pays for starting the session.
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_work(spark)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
