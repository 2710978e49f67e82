"""Comparing training runs: `runs` has one row per run, `metrics` one per (run_id, key)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridwright.operators.metrics import CURVE_METRICS, CURVE_SUFFIX
from gridwright.operators.resample import dedupe_first
from gridwright.operators.weather import cells
from gridwright.session import written

# Report order of backends and of feature-set stems.
BACKEND_RANK = {"xgboost": 0, "autogluon": 1, "mlforecast": 2, "tso": 9}
STEM_RANK = {"baseline": 0, "enriched": 1, "full": 2, "tso_baseline": 8, "other": 9}

# Tags by start time, each valid before its end.
LINEAGE_COLUMNS = ("generation", "data_quality", "nwp_source", "change_reason")
LINEAGE = [
    (datetime(2026, 4, 9, 23), ("gen1", "LEAKED", "era5", "initial_run_era5_and_ag_leak")),
    (datetime(2026, 4, 10, 6), ("gen2", "LEAKED", "era5", "fixed_ag_tuning_leak_era5_still_present")),
    (None, ("gen3", "CLEAN", "forecast", "forecast_provider")),
]


def lookup(value: Column, table: dict[str, int], default: int) -> Column:
    out = None
    for name, rank in table.items():
        out = F.when(value == name, rank) if out is None else out.when(value == name, rank)
    return out.otherwise(default)


def feature_set_stem(name: Column) -> Column:
    stem = F.regexp_extract(name, r"^(?:wind|demand|solar)_(.*)$", 1)
    return (
        F.when(name.isNull() | name.isin("", "none"), "tso_baseline")
        .when(name.rlike(r"^(wind|demand|solar)_"), stem)
        .otherwise("other")
    )


def horizon_of(key: Column) -> Column:
    return F.regexp_extract(key, r"^h(\d+)_(.+)$", 1).try_cast("int")


def metric_of(key: Column) -> Column:
    return F.nullif(F.regexp_extract(key, r"^h(\d+)_(.+)$", 2), F.lit(""))


def parse_metric_keys(metrics: DataFrame) -> DataFrame:
    """Adds `horizon` and `metric`; both null for keys of another form."""
    return metrics.withColumns({"horizon": horizon_of(F.col("key")), "metric": metric_of(F.col("key"))})


def classify_lineage(runs: DataFrame, start: str = "start_time", rules=tuple(LINEAGE)) -> DataFrame:
    """Lineage tags from the start time."""
    ts, tags = F.col(start), None
    for end, values in rules:
        value = F.struct(*[F.lit(v).alias(c) for c, v in zip(LINEAGE_COLUMNS, values)])
        holds = ts.isNotNull() if end is None else ts < F.lit(end.isoformat()).cast(runs.schema[start].dataType)
        tags = F.when(holds, value) if tags is None else tags.when(holds, value)
    return runs.withColumn("_tags", tags).select(*runs.columns, "_tags.*")


def parent_runs(runs: DataFrame, data_quality: str | None = "CLEAN") -> DataFrame:
    parents = runs.where(F.col("run_type") == "parent")
    return parents if data_quality is None else parents.where(F.col("data_quality") == data_quality)


def dominant(df: DataFrame, column: str) -> DataFrame:
    """The most common value, the smallest one among equals."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg((-F.count("*")).alias("_n"))
    return counts.agg(F.min_by(column, F.struct("_n", column)).alias(column))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run without a parent; the newest of all if every run has one."""
    rank = F.struct(F.col("parent_run_id").isNull(), F.col("start_time"), F.col("run_id"))
    return runs.agg(F.max_by("run_id", rank).alias("run_id"))


def with_labels(runs: DataFrame) -> DataFrame:
    label = F.concat_ws("/", F.coalesce("backend", F.lit("?")), F.coalesce("feature_set", F.lit("?")))
    return runs.withColumns({
        "label": label,
        "backend_rank": lookup(F.col("backend"), BACKEND_RANK, 99),
        "stem_rank": lookup(feature_set_stem(F.col("feature_set")), STEM_RANK, 9),
    })


def _by_run(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Both sides grow with the runs, and the planner takes generated or written ones for far smaller than they are, so a
    broadcast would fill the driver: the join sorts both."""
    return left.hint("merge").join(right, "run_id", how)


def run_cells(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """(run columns, horizon, mae, rmse, skill_score): one row per run and horizon."""
    parsed = parse_metric_keys(metrics).where(F.col("metric").isin("mae", "rmse", "skill_score"))
    wide = parsed.groupBy("run_id", "horizon").agg(*cells("metric", ["mae", "rmse", "skill_score"]))
    return _by_run(with_labels(runs), wide)


#: More horizons than this are no table that anyone reads.
MOST_HORIZONS = 512
PIVOTED = ("mae", "rmse", "skill_score")


def runs_pivot(runs: DataFrame, metrics: DataFrame, horizons: Sequence[int] | None = None) -> DataFrame:
    """One row per run, one column `h{h}_{metric}` per horizon; order by the rank columns. Horizons that are not given are
    those that any run has a value for."""
    if horizons is None:
        return _found_pivot(runs, metrics)[0]
    keys = [f"h{h}_{m}" for m in PIVOTED for h in horizons]
    wide = metrics.where(F.col("key").isin(*keys)).groupBy("run_id").agg(*cells("key", keys))
    return _by_run(with_labels(runs), wide, "left")


def _found_pivot(runs: DataFrame, metrics: DataFrame) -> tuple[DataFrame, list[int]]:
    """The pivot and its horizons. One aggregation puts each run's cells into a map, the greatest value of a key that comes
    twice; the horizons are read off the written maps."""
    parsed = parse_metric_keys(metrics).where(F.col("metric").isin(*PIVOTED))
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    packed = parsed.groupBy("run_id").agg(entries.alias("_entries"))
    last = F.filter("_entries", lambda x, i: (i == F.size("_entries") - 1) | (F.get("_entries", i + 1)["key"] != x["key"]))
    maps = written(packed.select("run_id", F.map_from_entries(last).alias("_cells")), "cells")
    found = maps.select(F.explode(F.map_keys("_cells")).alias("key")).select(horizon_of(F.col("key")).alias("h")).distinct()
    horizons = sorted(r.h for r in found.limit(MOST_HORIZONS + 1).collect())
    if len(horizons) > MOST_HORIZONS:
        raise ValueError(f"more than {MOST_HORIZONS} horizons: name those to show")
    keys = [f"h{h}_{m}" for m in PIVOTED for h in horizons]
    wide = _by_run(with_labels(runs), maps, "left")
    return wide.select(*[c for c in wide.columns if c != "_cells"], *[F.col("_cells")[k].alias(k) for k in keys]), horizons


def comparison_report(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per run: its label and, for every horizon that any run has, texts of its MAE, its skill and its skill against
    the baseline run."""
    wide, horizons = _found_pivot(runs, metrics)
    wide = written(wide, "pivot")
    is_base = (F.col("backend") == "xgboost") & (feature_set_stem(F.col("feature_set")) == "baseline")
    valued = F.greatest(*[F.col(f"h{h}_{m}").isNotNull() for h in horizons for m in PIVOTED], F.lit(False), F.lit(False))
    errors = [f"h{h}_{m}" for h in horizons for m in ("rmse", "mae")]
    base = wide.where(is_base & valued).agg(*[F.min_by(c, "run_id").alias(c) for c in errors], F.count("*").alias("_n")).first()
    out = []
    for h in horizons:
        # The baseline's RMSE decides where it has one, else its MAE; an error of zero compares to nothing.
        chosen = next((c for c in (f"h{h}_rmse", f"h{h}_mae") if base[c] is not None), None)
        against = 1 - F.col(chosen) / F.nullif(F.lit(base[chosen]), F.lit(0.0)) if chosen else F.lit(None).cast("double")
        out += [cell_text(F.col(f"h{h}_mae"), "%.0f", 0).alias(f"h{h}_mae"),
                cell_text(F.col(f"h{h}_skill_score"), "%.3f", 3).alias(f"h{h}_skill"),
                cell_text(against, "%+.3f", 3).alias(f"h{h}_skill_vs_baseline")]
    return wide.select("run_id", "label", *out)


def report_order(runs: DataFrame) -> DataFrame:
    return runs.orderBy("backend_rank", "stem_rank", "run_id")


def skill_vs_baseline(cells: DataFrame) -> DataFrame:
    """Adds `skill_vs_baseline` = 1 - error/error of the baseline run, per horizon.

    The baseline is the first xgboost run with a baseline feature set. The error is RMSE where the
    baseline has it, else MAE. The joined side has one row per horizon.
    """
    cells = written(cells, "cells")
    is_base = (F.col("backend") == "xgboost") & (feature_set_stem(F.col("feature_set")) == "baseline")
    chosen = cells.where(is_base).agg(F.min("run_id")).scalar()
    base = cells.where(is_base & (F.col("run_id") == chosen)).select(
        "horizon", F.col("rmse").alias("_rmse"), F.col("mae").alias("_mae"))
    by_rmse = 1 - F.col("rmse") / F.nullif(F.col("_rmse"), F.lit(0.0))
    by_mae = 1 - F.col("mae") / F.nullif(F.col("_mae"), F.lit(0.0))
    return (
        cells.join(F.broadcast(base), "horizon", "left")
        .withColumn("skill_vs_baseline", F.when(F.col("_rmse").isNotNull(), by_rmse).otherwise(by_mae))
        .drop("_rmse", "_mae")
    )


def cell_text(value: Column, pattern: str, digits: int) -> Column:
    """A formatted cell, a dash where there is no value. A value half way between two texts takes the even one; a small
    negative value keeps its sign."""
    even = F.bround(value, digits)
    minus_zero = F.lit("-" + f"{0:.{digits}f}")
    shown = F.when((even == 0) & (value < 0), minus_zero).otherwise(F.format_string(pattern, even))
    return F.coalesce(F.when(value.isNotNull(), shown), F.lit("—"))


def comparison_table(cells: DataFrame) -> DataFrame:
    """Formatted cells per run and horizon: whole MAE, skills with three decimals."""
    out = [cell_text(F.col("mae"), "%.0f", 0).alias("mae"), cell_text(F.col("skill_score"), "%.3f", 3).alias("skill")]
    if "skill_vs_baseline" in cells.columns:
        out.append(cell_text(F.col("skill_vs_baseline"), "%+.3f", 3).alias("skill_vs_baseline"))
    return cells.select("run_id", "label", "horizon", *out)


def backfill_curves(children: DataFrame, metrics: DataFrame, step_minutes: int) -> DataFrame:
    """Metrics of child runs as points on their parents' curves.

    `children` has (run_id, parent_run_id). A child whose keys name several horizons is left out;
    of several children with one horizon the first by run_id counts. `persistence_*` keys carry no
    horizon of their own and take their run's.
    """
    own = _by_run(metrics, children)
    parsed = parse_metric_keys(own).withColumn(
        "metric", F.coalesce("metric", F.when(F.col("key").rlike("^persistence_(?!mape)"), F.col("key"))))
    usable = parsed.where(F.col("metric").isNotNull())
    heads = (
        usable.groupBy("parent_run_id", "run_id")
        .agg(F.min("horizon").alias("h"), F.max("horizon").alias("_most"))
        .where(F.col("h") == F.col("_most")).drop("_most")
    )
    first = heads.groupBy("parent_run_id", "h").agg(F.min("run_id").alias("run_id"))
    points = usable.where(F.col("metric").isin(*CURVE_METRICS)).join(first, ["parent_run_id", "run_id"])
    # One key may appear with and without the horizon prefix; the prefixed one comes first.
    named = points.select(
        F.col("parent_run_id").alias("run_id"),
        F.concat("metric", F.lit(CURVE_SUFFIX)).alias("metric"),
        (F.col("h") * step_minutes).alias("step"), "value", "key")
    return dedupe_first(named, ["run_id", "metric", "step"], [F.col("key")]).drop("key")


def best_model(scores: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Model with the lowest MAE, the name deciding between equals."""
    rank = F.struct("mae", "model")
    return scores.where(F.col("mae").isNotNull()).groupBy(*by).agg(
        F.min_by("model", rank).alias("champion"), F.min("mae").alias("mae"))


def leaderboard(scores: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Candidates ranked by MAE. One row per (group, model), so a group is as large as the candidate list."""
    w = Window.partitionBy(*by).orderBy("mae", "model")
    return scores.withColumn("rank", F.row_number().over(w))
