"""Step-by-step forecasts that feed their own predictions back, and rolling-origin checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridwright.config import DOMAINS, Domain
from gridwright.operators.features import lag_transforms
from gridwright.operators.resample import with_fold
from gridwright.operators.windows import Series, add_targets, longest_series
from gridwright.session import small_table, written

STEPS_PER_TABLE = 12


def lag_feature_names(domain: Domain, column: str = "y") -> list[str]:
    return [f"{column}_lag{k}" for k in domain.lags] + [
        f"{column}_roll_{kind}_{w}" for w in domain.windows for kind in ("mean", "std")]


def recent_history(df: DataFrame, series: Series, column: str, rows: int) -> DataFrame:
    """One row per series: its last `rows` values in time order, and its last time.

    Ranking with a limit drops all but `rows` rows of a series before the shuffle, so a long series
    costs no more than a short one.
    """
    newest = Window.partitionBy(*series.keys).orderBy(*series.order(descending=True))
    recent = df.select(*series.keys, series.time, column, F.row_number().over(newest).alias("_back")).where(
        F.col("_back") <= rows)
    packed = F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), column)))
    return recent.groupBy(*series.keys).agg(
        F.max(series.time).alias("last_ts"), packed.alias("_packed")
    ).select(*series.keys, "last_ts", F.col(f"_packed.{column}").alias("history"))


def history_features(
    history: Column, domain: Domain, column: str = "y"
) -> tuple[dict[str, Column], dict[str, Column]]:
    """The lag and rolling features of the step after the history.

    Two groups to add one after the other: deviations read the mean columns, since a mean written
    into their lambda would be computed again for every element.
    """
    first = {f"{column}_lag{k}": F.try_element_at(history, F.lit(-k)) for k in domain.lags}
    second = {}
    for w in domain.windows:
        enough = F.size(history) >= w
        tail = F.slice(history, F.greatest(F.size(history) - w + 1, F.lit(1)), w)
        mean = F.col(f"{column}_roll_mean_{w}")
        total = F.aggregate(tail, F.lit(0.0), lambda a, x: a + x)
        first[f"{column}_roll_mean_{w}"] = F.when(enough, total / w)
        second[f"{column}_roll_std_{w}"] = F.when(enough, F.sqrt(_squares(tail, mean) / (w - 1)))
    return first, second


def _squares(values: Column, mean: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))


def _covariates(
    future: DataFrame, state: DataFrame, series: Series, names: Sequence[str], steps: int, step_minutes: int,
) -> DataFrame:
    """(keys, covariates) with one struct per step of the series whose future values are complete: one row, without nulls,
    at each of its next `steps` times."""
    past = F.unix_micros(F.col(series.time).cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))
    rows = future.select(*series.keys, series.time, *names).join(state.select(*series.keys, "last_ts"), list(series.keys))
    numbered = rows.withColumn("_step", past / (step_minutes * 60_000_000)).where(
        F.col("_step").between(1, steps) & (F.col("_step") == F.floor("_step"))).dropna(subset=list(names))
    packed = F.array_sort(F.collect_list(F.struct(F.col("_step").cast("int").alias("_step"), *[F.col(n).cast("double").alias(n) for n in names])))
    return numbered.groupBy(*series.keys).agg(packed.alias("covariates"), F.count_distinct("_step").alias("_steps")).where(
        (F.col("_steps") == steps) & (F.size("covariates") == steps)).drop("_steps")


def _fed_back(history: Column, x: Column | None, names: Sequence[str], weights: Sequence[float], domain: Domain, column: str) -> Column:
    """A linear model's value for the step after the history, all of it one expression."""
    terms = []
    for name, weight in zip(names, weights):
        kind, _, k = name.removeprefix(f"{column}_").rpartition("_")
        if name in {f"{column}_lag{n}" for n in domain.lags}:
            value = F.try_element_at(history, F.lit(-int(name.removeprefix(f"{column}_lag"))))
        elif name in lag_feature_names(domain, column):
            width = int(k)
            tail = F.slice(history, -width, width)
            mean = F.aggregate(tail, F.lit(0.0), lambda a, y: a + y) / width
            value = mean if kind == "roll_mean" else _deviation(tail, mean, width)
        else:
            value = x[name]
        terms.append(float(weight) * value)
    return reduce(lambda a, b: a + b, terms)


def _deviation(values: Column, mean: Column, width: int) -> Column:
    """Sample deviation. A mean that stands in an array of one is computed once, not for every value it is taken from."""
    return F.element_at(F.transform(F.array(mean), lambda m: F.sqrt(_squares(values, m) / (width - 1))), 1)


def _linear(model: Model) -> tuple[list[str], LinearRegressionModel] | None:
    stages = model.stages if isinstance(model, PipelineModel) else []
    if len(stages) == 2 and isinstance(stages[0], VectorAssembler) and isinstance(stages[1], LinearRegressionModel):
        return stages[0].getInputCols(), stages[1]
    return None


def recursive_forecast(
    df: DataFrame, model: Model, domain_name: str, steps: int,
    series: Series = Series(("unique_id",), "ds"), column: str = "y",
    future: DataFrame | None = None, exogenous: Sequence[str] = (),
) -> DataFrame:
    """`steps` predictions per series, each computed from history and the predictions before it.

    `future` holds the values of the `exogenous` columns at the times to come; they are joined once and go with the series
    as an array by step. Series too short for the longest lag, or without a future value for some step, have no forecast.

    The state is one bounded array per series, so no step shuffles. A linear model's whole horizon is one fold over that
    array. Any other model takes a plan per step; every few steps the state is written, which keeps the plan short.
    """
    domain = DOMAINS[domain_name]
    need = max(*domain.lags, *domain.windows)
    state = recent_history(df, series, column, need).where(F.size("history") >= need)
    if exogenous:
        if future is None:
            raise ValueError(f"future values of {', '.join(exogenous)} are needed")
        state = state.join(_covariates(future, state, series, exogenous, steps, domain.step_minutes), list(series.keys))
    linear = _linear(model)
    if linear:
        names, fitted = linear
        weights, start = fitted.coefficients.toArray().tolist(), float(fitted.intercept)
        along = F.col("covariates") if exogenous else F.sequence(F.lit(1), F.lit(steps))
        whole = F.aggregate(along, F.col("history"), lambda h, x: F.concat(
            h, F.array(_fed_back(h, x, names, weights, domain, column) + start)))
        state = state.withColumn("_out", F.slice(whole, F.size("history") + 1, steps))
    else:
        state = _stepwise(state, model, domain, steps, series, column, exogenous, need)
    step_time = F.make_dt_interval(mins=((F.col("_at") + 1) * domain.step_minutes).cast("int"))
    return state.select(
        *series.keys, "last_ts", F.posexplode("_out").alias("_at", "prediction")
    ).select(*series.keys, (F.col("last_ts") + step_time).alias(series.time), "prediction")


def _stepwise(
    state: DataFrame, model: Model, domain: Domain, steps: int, series: Series, column: str, exogenous: Sequence[str], need: int,
) -> DataFrame:
    state = state.withColumn("_out", F.expr("cast(array() as array<double>)"))
    first, second = history_features(F.col("history"), domain, column)
    kept = [*[F.col(k) for k in series.keys], F.col("last_ts"), *([F.col("covariates")] if exogenous else [])]
    advance = [
        *kept, F.concat(F.slice("history", 2, need), F.array("prediction")).alias("history"),
        F.concat("_out", F.array("prediction")).alias("_out")]
    for step in range(1, steps + 1):
        ready = state.withColumns(first).withColumns(second)
        if exogenous:
            ready = ready.withColumns({n: F.element_at("covariates", step)[n] for n in exogenous})
        state = model.transform(ready).select(*advance)
        if step % STEPS_PER_TABLE == 0 and step < steps:
            state = written(state, "forecast")
    return state


def fit_one_step(
    df: DataFrame, domain_name: str, estimator: Estimator,
    series: Series = Series(("unique_id",), "ds"), column: str = "y", features: Sequence[str] | None = None,
    exogenous: Sequence[str] = (),
) -> PipelineModel:
    """A model of the next value from lag and rolling features, or those of them in `features`, and from the row's own
    `exogenous` columns. Rows that lack any of the domain's lags or windows are left out."""
    every = lag_feature_names(DOMAINS[domain_name], column)
    names = [*(every if features is None else features), *exogenous]
    rows = lag_transforms(df, domain_name, series, column).dropna(subset=[column, *every, *exogenous])
    return Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="features"), estimator
    ]).fit(rows.withColumn("target", F.col(column)))


def _fold_rows(
    df: DataFrame, domain: Domain, domain_name: str, horizons: Sequence[int], series: Series, column: str, names: Sequence[str],
) -> DataFrame:
    """Rows with all `names`, their targets and `_end`, the last time of their series; written once."""
    longest = longest_series(df, series)
    featured = lag_transforms(df, domain_name, series, column, longest=longest)
    targeted = add_targets(featured, series, column, horizons, longest=longest)
    ends = targeted.groupBy(*series.keys).agg(F.max(series.time).alias("_end"))
    every = dict.fromkeys([*lag_feature_names(domain, column), *names])
    return written(targeted.join(ends, list(series.keys)).dropna(subset=list(every)), "folds")


def _cutoff(fold: int, n_windows: int, span: int) -> Column:
    return F.col("_end") - F.make_dt_interval(secs=F.lit((n_windows - fold) * span).cast("decimal(18,6)"))


def _origins(rows: DataFrame, series: Series, n_windows: int, span: int, columns: Sequence[str]) -> DataFrame:
    """(keys, fold, cutoff, time, columns): the last row of each series at or before each fold's cutoff."""
    kept = F.struct(series.time, *columns)
    order = F.struct(series.time, *series.ties)
    cutoffs = [_cutoff(f, n_windows, span) for f in range(n_windows)]
    last = rows.groupBy(*series.keys).agg(*[
        F.struct(F.lit(f).alias("fold"), F.max(c).alias("cutoff"),
                 F.max_by(kept, F.when(F.col(series.time) <= c, order)).alias("row")).alias(f"_fold{f}")
        for f, c in enumerate(cutoffs)])
    each = last.select(*series.keys, F.inline(F.array(*[f"_fold{f}" for f in range(n_windows)])))
    return each.where(F.col("row").isNotNull()).select(*series.keys, "fold", "cutoff", "row.*")


def cross_validate(
    df: DataFrame, domain_name: str, estimator: Estimator, horizons: Sequence[int], n_windows: int = 3,
    series: Series = Series(("unique_id",), "ds"), column: str = "y", exogenous: Sequence[str] = (),
) -> DataFrame:
    """Rolling-origin check: (keys, time, cutoff, y, horizon, prediction).

    Per fold and horizon a model is fitted on targets known at the fold's cutoff and predicts the value that many rows
    after the last one at or before the cutoff, from the features there. The featured rows are written once.
    """
    domain = DOMAINS[domain_name]
    names = [*lag_feature_names(domain, column), *exogenous]
    step = domain.step_minutes * 60
    span = max(horizons) * step
    rows = _fold_rows(df, domain, domain_name, horizons, series, column, names)
    targets = [f"target_h{h}" for h in horizons]
    origins = written(_origins(rows, series, n_windows, span, [*names, *targets]), "origins")
    parts = []
    for fold in range(n_windows):
        for h in horizons:
            ahead = F.make_dt_interval(secs=F.lit(h * step).cast("decimal(18,6)"))
            known = F.col(series.time) + ahead <= _cutoff(fold, n_windows, span)
            labelled = rows.withColumn("target", F.col(f"target_h{h}")).where(F.col("target").isNotNull())
            fitted = Pipeline(stages=[
                VectorAssembler(inputCols=names, outputCol="features"), estimator
            ]).fit(labelled.where(known))
            origin = origins.where((F.col("fold") == fold) & F.col(f"target_h{h}").isNotNull())
            parts.append(fitted.transform(origin).select(
                *series.keys, (F.col(series.time) + ahead).alias(series.time), "cutoff",
                F.col(f"target_h{h}").alias(column), F.lit(h).alias("horizon"), "prediction"))
    return reduce(DataFrame.unionByName, parts)


def _fold_sums(rows: DataFrame, names: Sequence[str], means: Sequence[float], horizons: Sequence[int], series: Series, step: int,
               n_windows: int) -> dict[tuple[int, int], np.ndarray]:
    """Sums of products of (1, centred features, centred target) by horizon and by the first fold that knows a row: all
    folds' fits in one aggregation, which combines before it shuffles."""
    span = max(horizons) * step * 1_000_000
    back = F.unix_micros(F.col("_end").cast("timestamp")) - F.unix_micros(F.col(series.time).cast("timestamp"))
    seen = F.array(*[
        F.struct(F.lit(h).alias("_h"), (F.col(f"target_h{h}") - means[-1]).alias("_t"),
                 F.greatest(F.lit(0), n_windows - F.floor((back - h * step * 1_000_000) / span)).cast("int").alias("_first"))
        for h in horizons])
    centred = [(F.col(n) - m).alias(f"_z{k}") for k, (n, m) in enumerate(zip(names, means))]
    long = rows.select(*centred, F.inline(seen)).where(F.col("_t").isNotNull() & (F.col("_first") < n_windows))
    values = [F.lit(1.0), *[F.col(f"_z{k}") for k in range(len(names))], F.col("_t")]
    pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    summed = long.groupBy("_h", "_first").agg(*[F.sum(values[i] * values[j]).alias(f"s{i}_{j}") for i, j in pairs])
    out = {}
    for row in summed.collect():
        sums = np.zeros((len(values), len(values)))
        for i, j in pairs:
            sums[i, j] = sums[j, i] = row[f"s{i}_{j}"]
        out[row._h, row._first] = sums
    return out


def least_squares_of(sums: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights of least squares from the sums of products of (1, features, target)."""
    count = sums[0, 0]
    spread = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:]) / count
    scale = np.sqrt(np.diag(spread)[:-1].clip(min=0))
    scale[scale == 0] = 1.0
    solved = np.linalg.lstsq(spread[:-1, :-1] / np.outer(scale, scale), spread[:-1, -1] / scale, rcond=None)[0] / scale
    return float((sums[0, -1] - sums[0, 1:-1] @ solved) / count), solved


def cross_validate_linear(
    df: DataFrame, domain_name: str, horizons: Sequence[int], n_windows: int = 3,
    series: Series = Series(("unique_id",), "ds"), column: str = "y", exogenous: Sequence[str] = (),
    features: Sequence[str] | None = None,
) -> DataFrame:
    """What `cross_validate` gives for least squares, without a fit per fold and horizon: one aggregation holds the sums of
    products by time block, and those of the blocks that a fold knows add up to its fit. `features` picks some of the lag
    and rolling columns. A fold and horizon without training rows has no predictions."""
    domain = DOMAINS[domain_name]
    names = [*(lag_feature_names(domain, column) if features is None else features), *exogenous]
    step = domain.step_minutes * 60
    rows = _fold_rows(df, domain, domain_name, horizons, series, column, names)
    targets = [f"target_h{h}" for h in horizons]
    first = rows.agg(*[F.avg(c) for c in [*names, column]]).first()
    means = [float(m or 0.0) for m in first]
    sums = _fold_sums(rows, names, means, horizons, series, step, n_windows)
    fits = []
    for h in horizons:
        for fold in range(n_windows):
            known = [sums[h, block] for block in range(fold + 1) if (h, block) in sums]
            if known:
                start, weights = least_squares_of(np.sum(known, axis=0))
                fits.append((fold, h, start + means[-1] - float(weights @ means[:-1]), weights.tolist()))
    models = small_table(df.sparkSession, fits, "fold int, horizon int, start double, weights array<double>")
    origins = _origins(rows, series, n_windows, max(horizons) * step, [*dict.fromkeys([*names, *targets])])
    judged = origins.join(F.broadcast(models), "fold")
    target = reduce(lambda a, h: a.when(F.col("horizon") == h, F.col(f"target_h{h}")), horizons[1:],
                    F.when(F.col("horizon") == horizons[0], F.col(f"target_h{horizons[0]}")))
    products = F.zip_with(F.array(*[F.col(n).cast("double") for n in names]), "weights", lambda x, w: x * w)
    ahead = F.make_dt_interval(secs=(F.col("horizon") * step).cast("decimal(18,6)"))
    return judged.withColumn("_target", target).where(F.col("_target").isNotNull()).select(
        *series.keys, (F.col(series.time) + ahead).alias(series.time), "cutoff", F.col("_target").alias(column), "horizon",
        F.aggregate(products, F.col("start"), lambda a, x: a + x).alias("prediction"))


def persistence_folds(
    df: DataFrame, domain_name: str, horizon: int, n_windows: int = 3,
    series: Series = Series(("unique_id",), "ds"), column: str = "y",
) -> DataFrame:
    """Test rows of each fold with the last value at or before the cutoff as the forecast.

    The last value of each fold's stretch is aggregated first; the window then sees one row per
    (series, fold).
    """
    folded = with_fold(df, series, horizon, DOMAINS[domain_name].step_minutes, n_windows)
    seen = F.when(F.col(column).isNotNull(), F.col(series.time))
    earlier = Window.partitionBy(*series.keys).orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    known = folded.groupBy(*series.keys, "fold").agg(F.max_by(column, seen).alias("_last")).select(
        *series.keys, "fold", F.last("_last", ignorenulls=True).over(earlier).alias("prediction"))
    return folded.where(F.col("fold") >= 0).join(known, [*series.keys, "fold"], "left")
