"""Comparing runs."""

from __future__ import annotations

from gridwright.catalog import views as V
from gridwright.catalog.evaluation import METRICS_WIDE, _wide_metrics
from gridwright.catalog.registry import query, r, rounded
from gridwright.operators import runs as R

STEM = """CASE WHEN feature_set IS NULL OR feature_set IN ('', 'none') THEN 'tso_baseline'
  WHEN regexp_matches(feature_set, '^(wind|demand|solar)_')
  THEN regexp_replace(feature_set, '^(wind|demand|solar)_', '') ELSE 'other' END"""
LABELLED = f"""SELECT *, coalesce(backend, '?') || '/' || coalesce(feature_set, '?') AS label,
  CASE backend WHEN 'xgboost' THEN 0 WHEN 'autogluon' THEN 1 WHEN 'mlforecast' THEN 2 WHEN 'tso' THEN 9 ELSE 99 END AS backend_rank,
  CASE {STEM} WHEN 'baseline' THEN 0 WHEN 'enriched' THEN 1 WHEN 'full' THEN 2 WHEN 'tso_baseline' THEN 8 ELSE 9 END AS stem_rank,
  {STEM} AS stem FROM runs"""
CELLS = """SELECT l.*, horizon, mae, rmse, skill_score FROM labelled l JOIN (
  SELECT run_id, CAST(regexp_extract(metric_key, '^h(\\d+)_', 1) AS INTEGER) AS horizon,
    max(CASE WHEN metric_key LIKE '%\\_mae' ESCAPE '\\' AND metric_key NOT LIKE '%persistence%' THEN value END) AS mae,
    max(CASE WHEN metric_key LIKE '%\\_rmse' ESCAPE '\\' THEN value END) AS rmse,
    max(CASE WHEN metric_key LIKE '%\\_skill\\_score' ESCAPE '\\' THEN value END) AS skill_score
  FROM metrics WHERE regexp_matches(metric_key, '^h\\d+_(mae|rmse|skill_score)$') GROUP BY 1, 2) AS m USING (run_id)"""
LABELLED_RUNS = V.also(V.RUNS, labelled=LABELLED)
RUN_CELLS = V.also(LABELLED_RUNS, cells=CELLS)
SKILLED = V.also(
    RUN_CELLS,
    base="""SELECT horizon, rmse AS base_rmse, mae AS base_mae FROM cells
  WHERE run_id = (SELECT min(run_id) FROM cells WHERE backend = 'xgboost' AND stem = 'baseline')""",
    skilled="""SELECT c.*, CASE WHEN base_rmse IS NOT NULL THEN 1 - rmse / nullif(base_rmse, 0)
  ELSE 1 - mae / nullif(base_mae, 0) END AS skill_vs_baseline FROM cells c LEFT JOIN base USING (horizon)""")


def _cells(spark, sf):
    return R.run_cells(V.runs(spark, sf), V.metrics(spark, sf))


@query("skill_vs_baseline", SKILLED + f"""SELECT run_id, horizon, {r('mae')}, {r('rmse')}, {r('skill_vs_baseline')} FROM skilled""")
def skill_vs_baseline(spark, sf):
    return rounded(R.skill_vs_baseline(_cells(spark, sf)).select(
        "run_id", "horizon", "mae", "rmse", "skill_vs_baseline"))


@query("comparison_table", SKILLED + """SELECT run_id, label, horizon, coalesce(printf('%.0f', mae), '—') AS mae,
  coalesce(printf('%.3f', skill_score), '—') AS skill,
  coalesce(printf('%+.3f', skill_vs_baseline), '—') AS skill_vs_baseline FROM skilled""")
def comparison_table(spark, sf):
    return R.comparison_table(R.skill_vs_baseline(_cells(spark, sf)))


@query("comparison_report", SKILLED + f"""SELECT run_id, label, {', '.join(
    f"""coalesce(max(CASE WHEN horizon = {h} THEN printf('%.0f', mae) END), '—') AS h{h}_mae,
  coalesce(max(CASE WHEN horizon = {h} THEN printf('%.3f', skill_score) END), '—') AS h{h}_skill,
  coalesce(max(CASE WHEN horizon = {h} THEN printf('%+.3f', skill_vs_baseline) END), '—') AS h{h}_skill_vs_baseline"""
    for h in V.RUN_HORIZONS)}
FROM labelled LEFT JOIN (SELECT run_id, horizon, mae, skill_score, skill_vs_baseline FROM skilled) AS s USING (run_id) GROUP BY 1, 2""")
def comparison_report(spark, sf):
    return R.comparison_report(V.runs(spark, sf), V.metrics(spark, sf))


PIVOT_KEYS = [f"h{h}_{m}" for m in ("mae", "rmse", "skill_score") for h in V.RUN_HORIZONS]


@query("runs_pivot", LABELLED_RUNS + f"""SELECT run_id, label, backend_rank, stem_rank,
  {', '.join(r(f"max(CASE WHEN metric_key = '{k}' THEN value END)", k) for k in PIVOT_KEYS)}
FROM labelled LEFT JOIN metrics USING (run_id) GROUP BY 1, 2, 3, 4""")
def runs_pivot(spark, sf):
    wide = R.runs_pivot(V.runs(spark, sf), V.metrics(spark, sf))
    return rounded(R.report_order(wide).select("run_id", "label", "backend_rank", "stem_rank", *PIVOT_KEYS))


@query("metrics_backfill", V.RUNS + f"""
, child AS (SELECT run_id, parent_run_id, metric_key, value,
    CAST(nullif(regexp_extract(metric_key, '^h(\\d+)_', 1), '') AS INTEGER) AS h,
    CASE WHEN regexp_matches(metric_key, '^h\\d+_') THEN regexp_replace(metric_key, '^h\\d+_', '')
         WHEN metric_key LIKE 'persistence_%' AND metric_key NOT LIKE 'persistence_mape%' THEN metric_key END AS metric
  FROM metrics JOIN runs USING (run_id) WHERE parent_run_id IS NOT NULL)
, heads AS (SELECT parent_run_id, run_id, min(h) AS h FROM child WHERE metric IS NOT NULL
    GROUP BY 1, 2 HAVING count(DISTINCT h) = 1)
, first_run AS (SELECT parent_run_id, h, min(run_id) AS run_id FROM heads GROUP BY 1, 2)
SELECT f.parent_run_id AS run_id, c.metric || '_by_horizon_min' AS metric, f.h * 10 AS step, {r('c.value', 'value')}
FROM first_run f JOIN child c ON c.parent_run_id = f.parent_run_id AND c.run_id = f.run_id
WHERE c.metric IN ('mae', 'rmse', 'bias', 'skill_score', 'mape', 'persistence_mae', 'persistence_rmse', 'persistence_bias')""")
def metrics_backfill(spark, sf):
    children = V.runs(spark, sf).where("parent_run_id IS NOT NULL").select("run_id", "parent_run_id")
    return rounded(R.backfill_curves(children, V.metrics(spark, sf), 10))


@query("run_lineage_classify", V.RUNS + """SELECT run_id,
  CASE WHEN start_time < TIMESTAMP '2026-04-09 23:00:00' THEN 'gen1' WHEN start_time < TIMESTAMP '2026-04-10 06:00:00' THEN 'gen2' ELSE 'gen3' END AS generation,
  CASE WHEN start_time < TIMESTAMP '2026-04-10 06:00:00' THEN 'LEAKED' ELSE 'CLEAN' END AS data_quality,
  CASE WHEN start_time < TIMESTAMP '2026-04-10 06:00:00' THEN 'era5' ELSE 'forecast' END AS nwp_source,
  CASE WHEN start_time < TIMESTAMP '2026-04-09 23:00:00' THEN 'initial_run_era5_and_ag_leak'
    WHEN start_time < TIMESTAMP '2026-04-10 06:00:00' THEN 'fixed_ag_tuning_leak_era5_still_present'
    ELSE 'forecast_provider' END AS change_reason FROM runs""")
def run_lineage_classify(spark, sf):
    return R.classify_lineage(V.runs(spark, sf).select("run_id", "start_time")).drop("start_time")


@query("runs_filter_parents", V.RUNS + "SELECT run_id FROM runs WHERE run_type = 'parent' AND data_quality = 'CLEAN'")
def runs_filter_parents(spark, sf):
    return R.parent_runs(V.runs(spark, sf)).select("run_id")


@query("dominant_domain", V.RUNS + """SELECT domain FROM (SELECT domain, count(*) AS n FROM runs GROUP BY 1) AS t
ORDER BY n DESC, domain LIMIT 1""")
def dominant_domain(spark, sf):
    return R.dominant(V.runs(spark, sf), "domain")


@query("latest_run", V.RUNS + """SELECT run_id FROM runs
ORDER BY (parent_run_id IS NULL) DESC, start_time DESC, run_id DESC LIMIT 1""")
def latest_run(spark, sf):
    return R.latest_run(V.runs(spark, sf))


@query("best_model", METRICS_WIDE + f"""SELECT horizon, arg_min(zone_id, mae) AS champion, {r('min(mae)', 'mae')}
FROM wide GROUP BY 1""")
def best_model(spark, sf):
    scores = _wide_metrics(spark, sf).withColumnRenamed("zone_id", "model")
    return rounded(R.best_model(scores))
