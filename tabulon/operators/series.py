"""Sensor series and fuzzy scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.operators.clean import minmax_fit, minmax_transform
from tabulon.operators.frame import time_slice


def snapshot_features(df: DataFrame, keys: Sequence, channels: Sequence[str]) -> DataFrame:
    """Mean absolute value of every channel per snapshot."""
    return df.groupBy(*keys).agg(*[F.avg(F.abs(c)).alias(c) for c in channels])


def window_features(df: DataFrame, ts: str, width: str, channels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The same for tumbling time windows of a continuous series."""
    w = F.window(ts, width)
    return (df.groupBy(*by, w.alias("_w")).agg(*[F.avg(F.abs(c)).alias(c) for c in channels])
            .select(*by, F.col("_w.start").alias("window_start"), *channels))


def train_test_by_time(df: DataFrame, ts: str, train: tuple, test: tuple,
                       cols: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The normal period fits the scaler, both parts are scaled by it."""
    train_df, test_df = time_slice(df, ts, *train), time_slice(df, ts, *test)
    state = minmax_fit(train_df, cols)
    return minmax_transform(train_df, state), minmax_transform(test_df, state), state


def triangle(x: Column, a: float, b: float, c: float) -> Column:
    """Degree of a triangular set with feet a, c and peak b."""
    rise = (x - a) / (b - a) if b != a else F.when(x >= a, 1.0).otherwise(0.0)
    fall = (c - x) / (c - b) if c != b else F.when(x <= c, 1.0).otherwise(0.0)
    return F.greatest(F.least(rise, fall), F.lit(0.0))


@dataclass(frozen=True)
class RuleBase:
    """Triangles per input and for the output; rules map one set per input to
    an output set: min for and / implication, max for aggregation."""

    inputs: dict[str, list[tuple[float, float, float]]]
    output: list[tuple[float, float, float]]
    output_range: tuple[float, float]
    rules: list[tuple[tuple[int, ...], int]]

    def __post_init__(self):
        if len(self.rules) > 10_000:
            raise ValueError("at most 10000 rules")


def memberships(df: DataFrame, base: RuleBase) -> DataFrame:
    cols = [triangle(F.col(v), *t).alias(f"{v}_{i}") for v, sets in base.inputs.items() for i, t in enumerate(sets)]
    return df.select("*", *cols)


def fuzzy_score(df: DataFrame, base: RuleBase, name: str = "score", grid: int = 101) -> DataFrame:
    """Centroid of the aggregated output set on a fixed grid; no rule fires: centre
    of the range. Rule strengths are column expressions, the grid is a matrix
    step per Arrow batch."""
    names = list(base.inputs)
    strength = []
    for sets, _ in base.rules:
        parts = [triangle(F.col(names[i]), *base.inputs[names[i]][s]) for i, s in enumerate(sets)]
        strength.append(F.least(*parts) if len(parts) > 1 else parts[0])
    fired = []
    for o in range(len(base.output)):
        mine = [strength[i] for i, (_, out) in enumerate(base.rules) if out == o]
        fired.append(F.greatest(*mine) if len(mine) > 1 else (mine[0] if mine else F.lit(0.0)))
    lo, hi = base.output_range
    ys = [lo + (hi - lo) * i / (grid - 1) for i in range(grid)]
    shapes = [[max(0.0, min((y - a) / (b - a) if b != a else float(y >= a), (c - y) / (c - b) if c != b else float(y <= c)))
               for y in ys] for a, b, c in base.output]
    levels = np.array(ys)
    sets = np.array(shapes)  # output set x grid point

    @F.pandas_udf("double")
    def centroid(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for fires in parts:
            f = np.column_stack([x.to_numpy(float) for x in fires])
            out = np.empty(len(f))
            for s in range(0, len(f), 4096):
                h = np.minimum(f[s:s + 4096, :, None], sets[None, :, :]).max(axis=1)
                mass = h.sum(axis=1)
                out[s:s + 4096] = np.where(mass > 0, (h @ levels) / np.where(mass > 0, mass, 1.0), (lo + hi) / 2)
            yield pd.Series(out)

    return df.withColumn(name, centroid(*fired))
