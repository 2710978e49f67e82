"""Forecast errors as aggregate columns, so that all groups and metrics share one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metrics that have a curve over horizons.
CURVE_METRICS = [
    f"{prefix}{metric}"
    for prefix in ("", "test_")
    for metric in ("mae", "rmse", "bias", "skill_score", "mape",
                   "persistence_mae", "persistence_rmse", "persistence_bias")
]
CURVE_SUFFIX = "_by_horizon_min"


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(yhat - y))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg((yhat - y) * (yhat - y)))


def bias(y: Column, yhat: Column) -> Column:
    return F.avg(yhat - y)


def mape(y: Column, yhat: Column) -> Column:
    """Undefined (null) as soon as one actual is zero."""
    share = F.avg(F.abs(F.try_divide(yhat - y, y)))
    return F.when(F.count_if(y == 0) == 0, share)


def skill(rmse_model: Column, rmse_reference: Column) -> Column:
    """1 - rmse/reference; against a perfect reference 1 if also perfect, else minus infinity."""
    against_zero = F.when(rmse_model == 0, 1.0).when(rmse_model.isNotNull(), float("-inf"))
    return F.when(rmse_reference == 0, against_zero).otherwise(
        1 - F.try_divide(rmse_model, rmse_reference))


def skill_score(y: Column, yhat: Column, persistence: Column) -> Column:
    return skill(rmse(y, yhat), rmse(y, persistence))


def error_columns(y: str, yhat: str, persistence: str | None = None) -> dict[str, Column]:
    actual, predicted = F.col(y), F.col(yhat)
    cols = {
        "mae": mae(actual, predicted),
        "rmse": rmse(actual, predicted),
        "bias": bias(actual, predicted),
        "mape": mape(actual, predicted),
    }
    if persistence:
        cols["skill_score"] = skill_score(actual, predicted, F.col(persistence))
    return cols


def persistence_columns(y: str, lag1: str, prefix: str = "persistence_") -> dict[str, Column]:
    """Errors of predicting that the last known value stays."""
    actual, last = F.col(y), F.col(lag1)
    return {f"{prefix}mae": mae(actual, last), f"{prefix}rmse": rmse(actual, last),
            f"{prefix}bias": bias(actual, last)}


def summarise(df: DataFrame, by: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()])


def regression_metrics(
    df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), persistence: str | None = None
) -> DataFrame:
    return summarise(df, by, error_columns(y, yhat, persistence))


# regimes: a row outside every regime has none and is left out

def wind_regime(speed: Column) -> Column:
    return F.when(speed < 5, "low").when(speed <= 12, "medium").when(speed > 12, "high")


def demand_regime(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour < 8, "off_peak").when(hour < 18, "shoulder").when(hour <= 23, "peak")


def solar_regime(irradiance: Column) -> Column:
    return (
        F.when((irradiance >= 0) & (irradiance < 200), "low_irradiance")
        .when((irradiance >= 200) & (irradiance < 600), "medium_irradiance")
        .when(irradiance >= 600, "high_irradiance")
    )


def regime_metrics(
    df: DataFrame, y: str, yhat: str, regime: Column, by: Sequence[str] = ()
) -> DataFrame:
    rows = df.withColumn("regime", regime).where(F.col("regime").isNotNull())
    cols = {"mae": mae(F.col(y), F.col(yhat)), "rmse": rmse(F.col(y), F.col(yhat)),
            "n_samples": F.count("*")}
    return summarise(rows, [*by, "regime"], cols)


def tso_baseline(
    df: DataFrame, actual: str = "load_mw", forecast: str = "tso_forecast_mw"
) -> DataFrame:
    """Errors of the grid operator's own forecast on the validation and test splits."""
    pairs = df.where(F.col("split").isin("val", "test")).dropna(subset=[actual, forecast])
    return regression_metrics(pairs, actual, forecast, ["split"])


MetricSpec = Callable[[Column, Column], Column]


def custom_metrics(
    df: DataFrame, y: str, yhat: str, metrics: Mapping[str, MetricSpec], by: Sequence[str] = ()
) -> DataFrame:
    """Metrics given as functions of (actual, predicted) columns: they aggregate like built-in ones."""
    return summarise(df, by, {n: f(F.col(y), F.col(yhat)) for n, f in metrics.items()})


def custom_metrics_additive(
    df: DataFrame,
    y: str,
    yhat: str,
    metrics: Mapping[str, Callable[[pd.Series, pd.Series], pd.Series]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean of plain Python losses per row.

    For losses that have no Column form. They run on Arrow batches and the mean is a built-in
    aggregate, so no group ever has to fit in one task.
    """
    losses = {}
    for name, fn in metrics.items():
        losses[f"_loss_{name}"] = F.pandas_udf(_typed_loss(fn), "double")(F.col(y), F.col(yhat))
    return summarise(
        df.withColumns(losses), by, {n: F.avg(f"_loss_{n}") for n in metrics})


def _typed_loss(fn):
    def loss(actual: pd.Series, predicted: pd.Series) -> pd.Series:
        return fn(actual, predicted)

    return loss


# reshaping metric tables

def metrics_long(
    wide: DataFrame, step_minutes: int, ids: Sequence[str] = (), horizon: str = "horizon"
) -> DataFrame:
    """(ids, step in minutes, curve name, value) from one row per horizon; unknown columns are left out."""
    known = [c for c in wide.columns if c in CURVE_METRICS]
    rows = wide.withColumn("step", F.col(horizon) * step_minutes).unpivot(
        [*ids, "step"], known, "metric", "value")
    return rows.where(F.col("value").isNotNull()).withColumn(
        "metric", F.concat("metric", F.lit(CURVE_SUFFIX)))


def metrics_prefixed(
    wide: DataFrame, ids: Sequence[str] = (), horizon: str = "horizon"
) -> DataFrame:
    """(ids, key, value) with keys `h{horizon}_{metric}`."""
    names = [c for c in wide.columns if c not in (*ids, horizon)]
    rows = wide.unpivot([*ids, horizon], names, "metric", "value")
    key = F.concat(F.lit("h"), F.col(horizon).cast("string"), F.lit("_"), F.col("metric"))
    return rows.where(F.col("value").isNotNull()).select(*ids, key.alias("key"), "value")
