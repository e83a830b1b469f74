"""Batch self-organising map.

An epoch is one pass: best unit per row, then sums per unit by partial
aggregation; only the units x d table returns, where the neighbourhood weights
smooth it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.cluster import distinct_rows

MAX_UNITS = 10_000


@dataclass
class SomModel:
    height: int
    width: int
    cols: list[str]
    codebook: np.ndarray
    errors: list[float] = field(default_factory=list)

    def as_table(self, df: DataFrame) -> DataFrame:
        rows = [(u, u // self.width, u % self.width, [float(x) for x in w])
                for u, w in enumerate(self.codebook)]
        return df.sparkSession.createDataFrame(rows, "unit int, x int, y int, weights array<double>")


def best_units(df: DataFrame, cols: Sequence[str], codebook, unit: str = "unit",
               distance: str = "distance") -> DataFrame:
    """First nearest unit per row, as matrix blocks of Arrow batches."""
    book = np.asarray(codebook, float)
    if len(book) > MAX_UNITS:
        raise ValueError(f"at most {MAX_UNITS} units")

    @F.pandas_udf("struct<unit: int, distance: double>")
    def nearest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for parts in batches:
            x = np.column_stack([p.to_numpy(float) for p in parts])
            units, dist = np.empty(len(x), int), np.empty(len(x))
            step = max(1, 4_000_000 // book.size)
            for s in range(0, len(x), step):
                d = ((x[s:s + step, None, :] - book[None, :, :]) ** 2).sum(-1)
                units[s:s + step] = d.argmin(1)
                dist[s:s + step] = np.sqrt(d.min(1))
            yield pd.DataFrame({"unit": units, "distance": dist})

    out = df.withColumn("_bmu", nearest(*[F.col(c).cast("double") for c in cols]))
    return out.withColumns({unit: F.col("_bmu.unit"), distance: F.col("_bmu.distance")}).drop("_bmu")


def neighbourhood(height: int, width: int, radius: float) -> np.ndarray:
    """Weights between units: 1 at the unit itself, falling to 0 past the
    radius; radius 0 updates the winner alone."""
    pos = np.array([(u // width, u % width) for u in range(height * width)], float)
    d2 = ((pos[:, None, :] - pos[None, :, :]) ** 2).sum(-1)
    if radius <= 0:
        return (d2 == 0).astype(float)
    return np.where(d2 <= radius * radius, np.exp(-d2 / (2.0 * radius * radius)), 0.0)


def epoch(df: DataFrame, model: SomModel, radius: float, step: float = 1.0) -> SomModel:
    d = len(model.cols)
    rows = best_units(df, model.cols, model.codebook).groupBy("unit").agg(
        F.count("*").alias("n"), F.sum("distance").alias("e"),
        *[F.sum(F.col(c).cast("double")).alias(f"s{j}") for j, c in enumerate(model.cols)]).collect()
    n, sums, err = np.zeros(len(model.codebook)), np.zeros((len(model.codebook), d)), 0.0
    for r in rows:
        n[r["unit"]] = r["n"]
        sums[r["unit"]] = [r[f"s{j}"] for j in range(d)]
        err += r["e"]
    h = neighbourhood(model.height, model.width, radius)
    weight = h @ n
    target = np.where(weight[:, None] > 0, (h @ sums) / np.maximum(weight, 1e-300)[:, None], model.codebook)
    book = model.codebook + step * (target - model.codebook)
    return SomModel(model.height, model.width, model.cols, book, [*model.errors, err / max(n.sum(), 1.0)])


def som_fit(df: DataFrame, cols: Sequence[str], height: int = 10, width: int = 10, *, radius: float = 4.0,
            step: float = 0.5, epochs: int = 20, key: Sequence[str] = (), seed: int = 12,
            codebook=None) -> SomModel:
    """The radius shrinks linearly to 0 over the epochs. ``errors`` holds the
    mean quantisation error before every epoch. Units start at distinct rows,
    which repeat only if there are fewer of them than units."""
    units = height * width
    if units > MAX_UNITS:
        raise ValueError(f"at most {MAX_UNITS} units")
    if codebook is None:
        rows = distinct_rows(df, cols, units, key, seed)
        codebook = [rows[u % len(rows)] for u in range(units)]
    model = SomModel(height, width, list(cols), np.asarray(codebook, float))
    data = df.select(*cols).persist()
    try:
        for t in range(epochs):
            shrink = 1.0 - t / max(epochs - 1, 1)
            model = epoch(data, model, radius * shrink, step)
    finally:
        data.unpersist()
    return model


def som_hits(df: DataFrame, model: SomModel, label: str) -> DataFrame:
    """Rows per unit and label, with grid position."""
    hits = best_units(df, model.cols, model.codebook).groupBy("unit", label).agg(F.count("*").alias("n"))
    return hits.select("unit", F.floor(F.col("unit") / model.width).cast("int").alias("x"),
                       F.pmod("unit", F.lit(model.width)).alias("y"), label, "n")


# grid neighbour offsets (row, column); hexagonal rows alternate their shift
RECT = [(-1, 0), (1, 0), (0, -1), (0, 1)]
HEX_EVEN = [(-1, -1), (-1, 0), (0, -1), (0, 1), (1, -1), (1, 0)]
HEX_ODD = [(-1, 0), (-1, 1), (0, -1), (0, 1), (1, 0), (1, 1)]


def _edges(book: DataFrame, offsets: list[tuple[int, int]], parity: int | None = None) -> DataFrame:
    from tabulon.functions.vectors import euclidean
    src = book if parity is None else book.where(F.pmod("x", F.lit(2)) == parity)
    steps = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in offsets])
    src = src.select("unit", "x", "y", "weights", F.explode(steps).alias("o")).select(
        "unit", "x", "y", "weights", F.col("o.dx").alias("dx"), F.col("o.dy").alias("dy"),
        (F.col("x") + F.col("o.dx")).alias("nx"), (F.col("y") + F.col("o.dy")).alias("ny"))
    other = book.select(F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("weights").alias("other"))
    return src.join(other, ["nx", "ny"]).withColumn("distance", euclidean(F.col("weights"), F.col("other")))


def u_matrix(book: DataFrame, hexagonal: bool = False) -> DataFrame:
    """Mean distance of every unit to its grid neighbours."""
    edges = (_edges(book, HEX_EVEN, 0).unionByName(_edges(book, HEX_ODD, 1)) if hexagonal
             else _edges(book, RECT))
    return edges.groupBy("unit", "x", "y").agg(F.avg("distance").alias("distance"))


def u_matrix_expanded(book: DataFrame) -> DataFrame:
    """Edge distances on a (2h-1) x (2w-1) grid: units sit on even cells, the
    cell between two units holds their distance."""
    e = _edges(book, [(0, 1), (1, 0)])
    return e.select((2 * F.col("x") + F.col("dx")).alias("x"), (2 * F.col("y") + F.col("dy")).alias("y"), "distance")


def grid_shape(units: int) -> tuple[int, int]:
    h = int(math.isqrt(units))
    while units % h:
        h -= 1
    return h, units // h
