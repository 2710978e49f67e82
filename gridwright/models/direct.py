"""One model per horizon, trained and judged with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.models.boosting import BoostedModel, Boosting, boost_horizons
from gridwright.operators.features import horizon_columns, select_horizon
from gridwright.operators.metrics import error_columns, persistence_columns, summarise
from gridwright.operators.runs import leaderboard
from gridwright.operators.windows import Series, add_targets
from gridwright.session import small_table, written


def targets_table(df: DataFrame, series: Series, target: str, horizons: Sequence[int]) -> DataFrame:
    """The split frame with `target_h{h}` columns, written once because every horizon reads it.

    Targets stay within (split, series).
    """
    keyed = Series(("split", *series.keys), series.time, series.ties)
    return written(add_targets(df, keyed, target, horizons), "targets")


def horizon_frame(
    table: DataFrame, features: Sequence[str], horizon: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Features under their canonical names, `target`, `split`; rows without a target are left out."""
    label = f"target_h{horizon}"
    rows = table.where(F.col(label).isNotNull())
    return select_horizon(
        rows.withColumn("target", F.col(label)), features, horizon, keep=["split", "target", *keep])


def _pipeline(features: Sequence[str], model: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), model])


def trainable_horizons(table: DataFrame, horizons: Sequence[int]) -> list[int]:
    """The horizons for which the training split has any target."""
    counts = table.where(F.col("split") == "train").agg(*[F.count(f"target_h{h}") for h in horizons]).first()
    return sorted(h for h, n in zip(horizons, counts) if n)


def train_horizons(
    table: DataFrame, features: Sequence[str], horizons: Sequence[int],
    settings: Boosting | Estimator = Boosting(),
) -> dict[int, BoostedModel | PipelineModel]:
    """One model per horizon, fitted on train: boosted trees, grown for all horizons together, each cut back to the
    rounds that do best on val, or any estimator of `target` from `features`. An estimator needs features free of nulls.
    A horizon without a training target has no model."""
    if isinstance(settings, Boosting):
        return boost_horizons(table, {h: horizon_columns(table.columns, features, h) for h in horizons}, settings)
    models = {}
    for h in trainable_horizons(table, horizons):
        present = list(horizon_columns(table.columns, features, h))
        train = horizon_frame(table, present, h).where(F.col("split") == "train").select("target", *present)
        models[h] = _pipeline(present, settings).fit(train)
    return models


def predict_horizons(
    models: Mapping[int, BoostedModel | PipelineModel],
    table: DataFrame,
    features: Sequence[str],
    keep: Sequence[str] = (),
    splits: Sequence[str] = ("val", "test"),
) -> DataFrame:
    """(split, target, keep, horizon, prediction) over all horizons."""
    parts = []
    for h, model in models.items():
        present = list(horizon_columns(table.columns, features, h))
        rows = horizon_frame(
            table, present, h, [c for c in keep if c not in present]
        ).where(F.col("split").isin(*splits))
        parts.append(model.transform(rows).select(
            "split", "target", *keep, F.lit(h).alias("horizon"), "prediction"))
    none = table.select(
        "split", F.lit(0.0).alias("target"), *keep, F.lit(0).alias("horizon"), F.lit(0.0).alias("prediction")).limit(0)
    return reduce(DataFrame.unionByName, parts, none)


def evaluate_horizons(predictions: DataFrame, lag1: str | None = None) -> DataFrame:
    """Errors per (horizon, split), with persistence and skill where the last value is known."""
    cols = error_columns("target", "prediction", lag1)
    if lag1:
        cols |= persistence_columns("target", lag1)
    return summarise(predictions, ["horizon", "split"], {"n_rows": F.count("*"), **cols})


def default_candidates(depth: int = 5, trees: int = 20, seed: int = 7) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": "target", "predictionCol": "prediction"}
    return {
        "linear": LinearRegression(regParam=0.1, **common),
        "tree": DecisionTreeRegressor(maxDepth=depth, seed=seed, **common),
        "forest": RandomForestRegressor(maxDepth=depth, numTrees=trees, seed=seed, **common),
        "boosted": GBTRegressor(maxDepth=depth, maxIter=trees, seed=seed, **common),
    }


def model_leaderboard(
    table: DataFrame,
    features: Sequence[str],
    horizon: int,
    candidates: Mapping[str, Estimator] | None = None,
) -> DataFrame:
    """Candidates fitted on train alone and ranked by their error on val, which no fit has seen."""
    present = list(horizon_columns(table.columns, features, horizon))
    rows = horizon_frame(table, present, horizon)
    train, val = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "val")
    scored = [
        _pipeline(present, estimator).fit(train).transform(val).select(
            F.lit(name).alias("model"), F.lit(horizon).alias("horizon"), "target", "prediction")
        for name, estimator in (candidates or default_candidates()).items()
    ]
    errors = error_columns("target", "prediction")
    scores = summarise(
        reduce(DataFrame.unionByName, scored), ["horizon", "model"],
        {"mae": errors["mae"], "rmse": errors["rmse"]})
    return leaderboard(scores)


def greedy_weights(gram: np.ndarray, cross: np.ndarray, rounds: int) -> np.ndarray:
    """Shares of an average of models, drawn with replacement: each draw is the one that lowers the squared error most.
    `gram` holds the sums of products of the models' predictions, `cross` those with the target."""
    counts = np.zeros(len(cross))
    best, best_error = counts, np.inf
    for drawn in range(1, rounds + 1):
        tries = [(counts + one) / drawn for one in np.eye(len(cross))]
        errors = [w @ gram @ w - 2 * w @ cross for w in tries]
        pick = int(np.argmin(errors))
        counts = tries[pick] * drawn
        if errors[pick] < best_error:
            best, best_error = tries[pick], errors[pick]
    return best


def _fitted(rows: DataFrame, present: Sequence[str], candidates: Mapping[str, Estimator]) -> PipelineModel:
    """All candidates as one model: a prediction column per candidate, from features assembled once. Every fit reads the rows
    several times, so they are kept meanwhile."""
    assembler = VectorAssembler(inputCols=list(present), outputCol="features")
    ready = assembler.transform(rows).select("target", "features").persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        fits = [c.copy({c.predictionCol: name}).fit(ready) for name, c in candidates.items()]
    finally:
        ready.unpersist()
    return PipelineModel(stages=[assembler, *fits])


def out_of_fold(rows: DataFrame, present: Sequence[str], candidates: Mapping[str, Estimator], folds: int) -> DataFrame:
    """(target, a column per candidate): each row predicted by fits that have not seen its fold."""
    parts = []
    for fold in range(folds):
        fitted = _fitted(rows.where(F.col("fold") != fold), present, candidates)
        parts.append(fitted.transform(rows.where(F.col("fold") == fold)).select("target", *candidates))
    return reduce(DataFrame.unionByName, parts)


def _ensemble_scores(
    table: DataFrame, features: Sequence[str], horizon: int, candidates: Mapping[str, Estimator], folds: int, draws: int, time: str,
) -> DataFrame:
    present = list(horizon_columns(table.columns, features, horizon))
    week = F.pmod(F.xxhash64(F.date_trunc("week", F.col(time))), F.lit(folds))
    frame = horizon_frame(table.withColumn("fold", week), present, horizon, ["fold"])
    train = frame.where(F.col("split") == "train")
    names = list(candidates)
    held = out_of_fold(train, present, candidates, folds)
    products = {f"{a}|{b}": F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in [*names[i:], "target"]}
    sums = held.agg(*[c.alias(n) for n, c in products.items()]).first()
    gram = np.array([[float(sums[f"{a}|{b}" if f"{a}|{b}" in products else f"{b}|{a}"] or 0.0) for b in names] for a in names])
    shares = greedy_weights(gram, np.array([float(sums[f"{a}|target"] or 0.0) for a in names]), draws)
    scored = _fitted(train, present, candidates).transform(frame.where(F.col("split") == "val"))
    mixed = reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(n) for w, n in zip(shares, names)])
    long = scored.withColumn("ensemble", mixed).select("target", *names, "ensemble").unpivot(
        "target", [*names, "ensemble"], "model", "prediction")
    share = small_table(table.sparkSession, [*zip(names, map(float, shares)), ("ensemble", None)], "model string, share double")
    errors = error_columns("target", "prediction")
    scores = summarise(long, ["model"], {"mae": errors["mae"], "rmse": errors["rmse"]})
    return scores.join(F.broadcast(share), "model").withColumn("horizon", F.lit(horizon))


def ensemble_leaderboard(
    table: DataFrame, features: Sequence[str], horizons: Sequence[int], candidates: Mapping[str, Estimator] | None = None,
    folds: int = 2, draws: int = 20, parallel: int = 5, time: str = "timestamp_utc",
) -> DataFrame:
    """(horizon, model, mae, rmse, share, rank) of the candidates and of their greedy ensemble, by errors on val.

    The shares come from predictions of train rows by fits without the row's fold, a fold being a hash of the calendar
    week; one aggregate of their products is all that the selection sees. Horizons are fitted side by side.
    """
    every = candidates or default_candidates()
    known = trainable_horizons(table, horizons)
    with ThreadPool(max(1, min(parallel, len(known)))) as pool:
        parts = pool.map(inheritable_thread_target(table.sparkSession)(
            lambda h: _ensemble_scores(table, features, h, every, folds, draws, time)), known)
    none = table.select(
        F.lit("").alias("model"), *[F.lit(0.0).alias(c) for c in ("mae", "rmse", "share")], F.lit(0).alias("horizon")).limit(0)
    return leaderboard(reduce(DataFrame.unionByName, parts, none))
