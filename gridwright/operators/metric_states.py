"""Metrics of whole columns that are no built-in aggregate, as states that merge.

A metric says how a state starts, takes in a batch of actual and predicted values, merges with another and turns into a
number. Tasks keep one state per group and metric, and states meet level by level, so a group may be of any size and none
of its rows ever come together in one task.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups that a task keeps states of before it hands them on.
HELD_GROUPS = 4096
#: States of a group meet in so many tasks first, and theirs in one.
FAN_IN = 256


class Metric(Protocol):
    def start(self) -> Any: ...

    def update(self, state: Any, actual: np.ndarray, predicted: np.ndarray) -> Any: ...

    def merge(self, state: Any, other: Any) -> Any: ...

    def finish(self, state: Any) -> float | None: ...


@dataclass(frozen=True)
class Mean:
    """Mean of a loss per row."""

    loss: Callable[[np.ndarray, np.ndarray], np.ndarray]

    def start(self) -> tuple[float, int]:
        return 0.0, 0

    def update(self, state: tuple[float, int], actual: np.ndarray, predicted: np.ndarray) -> tuple[float, int]:
        return state[0] + float(np.sum(self.loss(actual, predicted))), state[1] + len(actual)

    def merge(self, state: tuple[float, int], other: tuple[float, int]) -> tuple[float, int]:
        return state[0] + other[0], state[1] + other[1]

    def finish(self, state: tuple[float, int]) -> float | None:
        return state[0] / state[1] if state[1] else None


def pinball(quantile: float) -> Mean:
    """Mean quantile loss of a forecast of that quantile."""
    return Mean(lambda actual, predicted: np.maximum(quantile * (actual - predicted), (quantile - 1) * (actual - predicted)))


@dataclass
class Sketch:
    """Sorted samples by level: one value of level k stands for 2 ** k rows."""

    levels: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0)])
    kept_even: bool = True


@dataclass(frozen=True)
class QuantileOf:
    """A quantile of a value per row, by a sketch of samples that halve.

    A level that is full is sorted and every other value moves up, the even and the odd ones in turn. Up to `size` rows the
    quantile is exact; beyond, the error in rank is below log2(rows / size) / size of all rows.
    """

    value: Callable[[np.ndarray, np.ndarray], np.ndarray]
    quantile: float = 0.5
    size: int = 2048

    def start(self) -> Sketch:
        return Sketch()

    def update(self, state: Sketch, actual: np.ndarray, predicted: np.ndarray) -> Sketch:
        values = np.asarray(self.value(actual, predicted), np.float64)
        for begin in range(0, len(values), self.size):
            state.levels[0] = np.concatenate((state.levels[0], values[begin:begin + self.size]))
            self._halve(state)
        return state

    def merge(self, state: Sketch, other: Sketch) -> Sketch:
        for k, values in enumerate(other.levels):
            if k == len(state.levels):
                state.levels.append(np.zeros(0))
            state.levels[k] = np.concatenate((state.levels[k], values))
        self._halve(state)
        return state

    def _halve(self, state: Sketch) -> None:
        k = 0
        while k < len(state.levels):
            if len(state.levels[k]) > self.size:
                values = np.sort(state.levels[k])
                odd = len(values) % 2
                # The greatest of an odd number stays, so that every value that moves up stands for two.
                paired = values[:len(values) - odd]
                if k + 1 == len(state.levels):
                    state.levels.append(np.zeros(0))
                state.levels[k + 1] = np.concatenate((state.levels[k + 1], paired[0 if state.kept_even else 1::2]))
                state.levels[k] = values[len(values) - odd:]
                state.kept_even = not state.kept_even
            k += 1

    def finish(self, state: Sketch) -> float | None:
        values = np.concatenate(state.levels)
        if not len(values):
            return None
        weights = np.concatenate([np.full(len(v), 2.0 ** k) for k, v in enumerate(state.levels)])
        order = np.argsort(values, kind="stable")
        values, ends = values[order], np.cumsum(weights[order])
        place = self.quantile * (ends[-1] - 1)
        low, high = (values[np.searchsorted(ends, x, side="right")] for x in (math.floor(place), math.ceil(place)))
        return float(low + (high - low) * (place - math.floor(place)))


def merged_metrics(
    df: DataFrame, y: str, yhat: str, metrics: Mapping[str, Metric], by: Sequence[str] = (), fan_in: int = FAN_IN,
) -> DataFrame:
    """(by, a column per metric), for any metric whose states merge. Rows without an actual or a predicted value are left
    out; a group without rows is not in the result, and a null key is a group of its own."""
    names, keys = list(metrics), [f"_k{i}" for i in range(len(by))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(y).cast("double").alias("_y"), F.col(yhat).cast("double").alias("_yhat"),
        F.spark_partition_id().alias("_part")).where(F.col("_y").isNotNull() & F.col("_yhat").isNotNull())
    kinds = T.StructType([T.StructField(k, df.schema[c].dataType) for c, k in zip(by, keys)])
    partial = T.StructType([*kinds, T.StructField("_part", T.LongType()), T.StructField("_states", T.BinaryType())])

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        part = 0

        def handed_on() -> pd.DataFrame:
            out = [(*values, part, pickle.dumps(states)) for values, states in held.items()]
            held.clear()
            return pd.DataFrame(out, columns=partial.names)

        for batch in batches:
            part = int(batch["_part"].iloc[0]) if len(batch) else part
            groups = batch.groupby(keys, dropna=False, sort=False) if keys else [((), batch)]
            for values, group in groups:
                # A missing key is the same one in every batch.
                key = tuple(None if pd.isna(v) else v for v in values)
                states = held.get(key) or [m.start() for m in metrics.values()]
                actual, predicted = group["_y"].to_numpy(), group["_yhat"].to_numpy()
                held[key] = [m.update(s, actual, predicted) for m, s in zip(metrics.values(), states)]
            if len(held) >= HELD_GROUPS:
                yield handed_on()
        if held:
            yield handed_on()

    def together(parts: pd.Series) -> list:
        states = None
        for raw in parts:
            other = pickle.loads(raw)
            states = other if states is None else [m.merge(a, b) for m, a, b in zip(metrics.values(), states, other)]
        return states

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        return group.head(1).assign(_states=[pickle.dumps(together(group["_states"]))])[partial.names]

    def finished(group: pd.DataFrame) -> pd.DataFrame:
        values = [m.finish(s) for m, s in zip(metrics.values(), together(group["_states"]))]
        return group[keys].head(1).assign(**{f"_m{i}": [np.nan if v is None else v] for i, v in enumerate(values)})

    states = rows.mapInPandas(collect, partial).withColumn("_part", F.pmod("_part", F.lit(fan_in)).cast("long"))
    states = states.groupBy(*keys, "_part").applyInPandas(joined, partial)
    result = T.StructType([*kinds, *[T.StructField(f"_m{i}", T.DoubleType()) for i in range(len(names))]])
    done = states.groupBy(*keys).applyInPandas(finished, result)
    return done.select(
        *[F.col(k).alias(c) for c, k in zip(by, keys)], *[F.nanvl(f"_m{i}", F.lit(None).cast("double")).alias(n) for i, n in enumerate(names)])
