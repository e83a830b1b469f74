"""Principal components (X1-X7) from mergeable moments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import vectors as V
from tabulon.functions.scale import bounded_rows


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(n, i, j, sum_i, sum_ij) rows for i <= j: a d x d summary of any number
    of rows, made by one partial aggregate and mergeable by addition."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    x = [F.col(c).cast("double") for c in cols]
    one = df.agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
                 *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs])
    cells = [F.struct(F.col("n"), F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}").alias("sum_i"),
                      F.col(f"s{j}").alias("sum_j"), F.col(f"p{i}_{j}").alias("sum_ij")) for i, j in pairs]
    return one.select(F.inline(F.array(*cells)))


def merge_moments(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sum_i", "sum_j", "sum_ij")])


def centred_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, mean_i, mean_j, comoment) rows for i <= j over the rows that have
    both cells: sums of products around the means, so data far from zero lose no
    digits.  One partial aggregate."""
    x, cells = [F.col(c).cast("double") for c in cols], []
    for i in range(len(x)):
        for j in range(i, len(x)):
            both = x[i].isNotNull() & x[j].isNotNull()
            a, b = F.when(both, x[i]), F.when(both, x[j])
            n = F.count(F.when(both, 1))
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), n.alias("n"), F.avg(a).alias("mean_i"),
                                  F.avg(b).alias("mean_j"), (F.covar_pop(a, b) * n).alias("comoment")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merge_centred(parts: DataFrame) -> DataFrame:
    """One table of centred moments from the rows of several: the products of the
    distances of their means add to the products inside them."""
    parts = parts.where("n > 0")
    means = parts.groupBy("i", "j").agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean_i")) / F.sum("n")).alias("_mi"),
        (F.sum(F.col("n") * F.col("mean_j")) / F.sum("n")).alias("_mj"))
    apart = F.col("n") * (F.col("mean_i") - F.col("_mi")) * (F.col("mean_j") - F.col("_mj"))
    return parts.join(means, ["i", "j"]).groupBy("i", "j").agg(
        F.first("_n").alias("n"), F.first("_mi").alias("mean_i"), F.first("_mj").alias("mean_j"),
        F.sum(F.col("comoment") + apart).alias("comoment"))


def covariance(state: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sample covariance, mean and n from a table of moments, centred or not."""
    rows = bounded_rows(state, 1_000_000, "moments")
    d = max(r["j"] for r in rows) + 1
    cov, mean, n = np.zeros((d, d)), np.zeros(d), rows[0]["n"]
    for r in rows:
        i, j = r["i"], r["j"]
        if "comoment" in state.columns:
            cov[i, j] = cov[j, i] = r["comoment"] / (r["n"] - 1)
            centre = r["mean_i"]
        else:
            cov[i, j] = cov[j, i] = (r["sum_ij"] - r["sum_i"] * r["sum_j"] / n) / (n - 1)
            centre = r["sum_i"] / n
        if i == j:
            mean[i] = centre
    return cov, mean, n


@dataclass
class PcaModel:
    cols: list[str]
    axes: np.ndarray      # k x d, rows are unit components by falling variance
    mean: np.ndarray
    variances: np.ndarray  # all d eigenvalues

    @property
    def ratio(self) -> np.ndarray:
        return self.variances / self.variances.sum()

    def as_table(self, df: DataFrame) -> DataFrame:
        rows = [(k, c, float(w), float(self.ratio[k])) for k, axis in enumerate(self.axes)
                for c, w in zip(self.cols, axis)]
        return df.sparkSession.createDataFrame(
            rows, "component int, column string, weight double, explained double")


def pca_from_moments(state: DataFrame, cols: Sequence[str], k: int | None = None) -> PcaModel:
    cov, mean, _ = covariance(state)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)
    values, axes = values[order], vectors[:, order].T
    # fixed sign: the largest-magnitude weight of every axis is positive
    pivot = np.abs(axes).argmax(axis=1)
    axes = axes * np.sign(axes[np.arange(len(axes)), pivot])[:, None]
    return PcaModel(list(cols), axes[: k or len(cols)], mean, values)


def pca_fit(df: DataFrame, cols: Sequence[str], k: int | None = None) -> PcaModel:
    # centring first keeps the sums well conditioned
    shift = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centred = df.select(*[(F.col(c) - F.lit(shift[c])).alias(c) for c in cols])
    model = pca_from_moments(moments(centred, cols), cols, k)
    model.mean = np.array([shift[c] for c in cols], float)
    return model


def pca_transform(df: DataFrame, cols: Sequence[str], axes, mean=None, name: str = "projected") -> DataFrame:
    """``X . W``; without ``mean`` the data are not centred."""
    return df.withColumn(name, V.project(list(cols), [list(map(float, a)) for a in axes],
                                         None if mean is None else list(map(float, mean))))


def choose_components(ratio: DataFrame, share: float = 0.9) -> DataFrame:
    """Smallest number of leading components reaching ``share``."""
    run = cumulative_variance(ratio)
    return run.where(F.col("cumulative") >= share * 100 - 1e-9).agg(F.min("component").alias("last")).select(
        (F.col("last") + 1).alias("components"))


def cumulative_variance(ratio: DataFrame) -> DataFrame:
    """Running share x 100 and the 60/80/90 % marks; one row per component."""
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # d rows
    whole = Window.partitionBy()
    c = F.sum("explained").over(w) / F.sum("explained").over(whole) * 100
    return ratio.select("component", "explained", c.alias("cumulative")).withColumns(
        {f"reaches_{m}": F.col("cumulative") >= m - 1e-9 for m in (60, 80, 90)})


def pca_reconstruct(df: DataFrame, axes, projected: str = "projected", mean=None,
                    name: str = "reconstructed") -> DataFrame:
    """``Y . W^T`` (+ mean); exact when all components are kept."""
    w = np.asarray(axes, float)
    cells = []
    for j in range(w.shape[1]):
        cell = F.lit(0.0 if mean is None else float(mean[j]))
        for k in range(w.shape[0]):
            cell = cell + F.get(projected, F.lit(k)) * float(w[k, j])
        cells.append(cell)
    return df.withColumn(name, F.array(*cells))


def reconstruction_error(df: DataFrame, cols: Sequence[str], reconstructed: str = "reconstructed",
                         name: str = "error") -> DataFrame:
    return df.withColumn(name, V.euclidean(list(cols), [F.get(reconstructed, F.lit(j)) for j in range(len(cols))]))


def incremental_pca(batches: Sequence[DataFrame], cols: Sequence[str], k: int | None = None) -> PcaModel:
    """Components from batches: only their moments are kept, taken around the
    means of the first batch so that data far from zero lose no digits."""
    first = batches[0].agg(*[F.avg(c).alias(c) for c in cols]).first()
    shift = {c: float(first[c] or 0.0) for c in cols}
    parts = [b.select(*[(F.col(c) - shift[c]).alias(c) for c in cols]) for b in batches]
    model = pca_from_moments(merge_moments(*[moments(b, cols) for b in parts]), cols, k)
    model.mean = model.mean + np.array([shift[c] for c in cols])
    return model


def project_points(points: DataFrame, cols: Sequence[str], model: PcaModel, name: str = "projected") -> DataFrame:
    """Centroids seen through the components of the data."""
    return pca_transform(points, cols, model.axes, model.mean, name)
