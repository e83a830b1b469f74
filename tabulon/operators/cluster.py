"""Partitional and fuzzy clustering (the U family).

Centroids are a bounded k x d table, inlined as literals, so one iteration is
one map-side pass with a partial aggregate of k rows: no join, no growing
lineage, nothing to checkpoint.  Several runs (seeds, values of k) advance in
the same pass under a run key.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import vectors as V
from tabulon.functions.scale import bounded_rows, hash_order, only_row
from tabulon.operators.hierarchy import agglomerative

MAX_CENTROIDS = 10_000
UNROLL_CELLS = 64

METRICS: dict[str, Callable] = {
    "euclidean": V.euclidean,
    "manhattan": V.manhattan,
    "cosine": V.cosine_distance,
}


@dataclass
class ClusterModel:
    """``labelling`` are the prototypes of the last assignment step and
    ``centroids`` those after the last update; equal once converged."""

    kind: str
    centroids: list
    labelling: list
    inertia: float
    iterations: int
    converged: bool
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    gamma: float = 0.8
    fuzzifier: float = 2.0
    trace: list[dict] = field(default_factory=list)

    def as_table(self, df: DataFrame) -> DataFrame:
        """(cluster, column, value) rows of the final prototypes."""
        cols = [*self.numeric, *self.categorical]
        rows = [(i, c, str(v)) for i, proto in enumerate(self.centroids) for c, v in zip(cols, proto)]
        return df.sparkSession.createDataFrame(rows, "cluster int, column string, value string")

    def predict(self, df: DataFrame, label: str = "cluster", distance: str = "distance") -> DataFrame:
        if self.kind == "fuzzy":
            return defuzzify(memberships(df, self.numeric, self.labelling, self.fuzzifier), label=label)
        return _assign(df, _distances(self, self.labelling), label, distance)


# ---- assignment ------------------------------------------------------------
def _assign(df: DataFrame, dists: Column, label: str, distance: str) -> DataFrame:
    """First nearest prototype and its distance."""
    d = F.col("_d")
    return (df.withColumn("_d", dists)
            .withColumn(distance, F.array_min(d))
            .withColumn(label, (F.array_position(d, F.col(distance)) - 1).cast("int"))
            .drop("_d"))


def assign_nearest(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]],
                   metric: str = "euclidean", label: str = "cluster",
                   distance: str = "distance") -> DataFrame:
    dists = _metric_array(METRICS[metric], cols, centroids)
    return _assign(df, dists, label, distance)


def assign_nearest_vector(df: DataFrame, features: str, centroids: Sequence[Sequence[float]],
                          metric: str = "euclidean", label: str = "cluster",
                          distance: str = "distance") -> DataFrame:
    table = F.lit([[float(v) for v in c] for c in centroids])
    dists = F.transform(table, lambda c: METRICS[metric](F.col(features), c))
    return _assign(df, dists, label, distance)


def pairwise_distances(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]],
                       metric: str = "euclidean", floor: float = 2.220446049250313e-16) -> DataFrame:
    """Distance of every row to every one of a bounded set of points."""
    cells = [F.struct(F.lit(i).alias("centroid"),
                      F.greatest(METRICS[metric](list(cols), [F.lit(float(v)) for v in c]),
                                 F.lit(floor)).alias("distance"))
             for i, c in enumerate(centroids)]
    return df.select("*", F.inline(F.array(*cells)))


def _metric_array(metric: Callable, cols: Sequence[str], centroids: Sequence) -> Column:
    """Distances to all centroids: unrolled while small (stays in codegen), one
    expression over a literal table beyond that."""
    if len(cols) * len(centroids) <= UNROLL_CELLS:
        return F.array(*[metric(list(cols), [F.lit(float(v)) for v in c]) for c in centroids])
    table = F.lit([[float(v) for v in c] for c in centroids])
    point = F.array(*[F.col(c).cast("double") for c in cols])
    return F.transform(table, lambda c: metric(point, c))


def _distances(model: ClusterModel, protos: list) -> Column:
    n = len(model.numeric)
    if model.kind == "kmeans":
        return _metric_array(V.euclidean, model.numeric, protos)
    out = []
    for p in protos:
        num = [F.lit(float(v)) for v in p[:n]]
        cat = [F.lit(v) for v in p[n:]]
        if model.kind == "kmodes":
            out.append(V.matching_distance(model.categorical, cat).cast("double"))
        else:
            out.append(V.mixed_distance(model.numeric, num, model.categorical, cat, model.gamma))
    return F.array(*out)


def distinct_rows(df: DataFrame, cols: Sequence[str], k: int, key: Sequence[str], seed: int) -> list[tuple]:
    """The first k distinct rows, or all if there are fewer, in the order of a
    seeded hash of the row key; of equal rows the first counts."""
    order = F.struct(hash_order(*key, F.lit(seed)).alias("h"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(key)])
    firsts = df.groupBy(*cols).agg(F.min(order).alias("_first"))
    return [tuple(r[c] for c in cols) for r in firsts.orderBy("_first", *cols).limit(k).collect()]


def starting_rows(df: DataFrame, cols: Sequence[str], k: int, key: Sequence[str], seed: int) -> list[tuple]:
    """k distinct rows in the order of a seeded hash of the row key."""
    found = distinct_rows(df, cols, k, key, seed)
    if len(found) < k:
        raise ValueError(f"only {len(found)} distinct rows for {k} clusters")
    return found


# ---- Lloyd-type iterations ---------------------------------------------------
def _one_pass(df: DataFrame, models: dict[Hashable, ClusterModel]) -> dict[Hashable, tuple[float, dict]]:
    """One assignment of all runs: inertia and updated prototypes per run."""
    runs = list(models)
    first = models[runs[0]]
    num, cat = first.numeric, first.categorical
    dists = [F.struct(F.lit(i).alias("run"), _distances(models[run], models[run].centroids).alias("d"))
             for i, run in enumerate(runs)]
    rows = df.select(*num, *cat, F.explode(F.array(*dists)).alias("_a")).select(
        *num, *cat, F.col("_a.run").alias("_run"), F.array_min("_a.d").alias("_dist"),
        (F.array_position("_a.d", F.array_min("_a.d")) - 1).cast("int").alias("_cluster"))
    means = {}
    for r in rows.groupBy("_run", "_cluster").agg(
            F.sum("_dist").alias("_sum"), *[F.avg(c).alias(c) for c in num]).collect():
        means[r["_run"], r["_cluster"]] = (r["_sum"], [r[c] for c in num])
    modes = {}
    if cat:
        cells = [F.struct(F.lit(i).alias("col"), F.col(c).alias("value")) for i, c in enumerate(cat)]
        counts = (rows.select("_run", "_cluster", F.inline(F.array(*cells)))
                  .groupBy("_run", "_cluster", "col", "value").agg(F.count("*").alias("n")))
        # most frequent level, the smallest one on a tie
        best = counts.groupBy("_run", "_cluster", "col").agg(
            F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m"))
        for r in best.collect():
            modes[r["_run"], r["_cluster"], r["col"]] = r["m"]["value"]
    out = {}
    for i, run in enumerate(runs):
        updated, inertia = [], 0.0
        for c, old in enumerate(models[run].centroids):
            if (i, c) not in means:  # an empty cluster keeps its prototype
                updated.append(tuple(old))
                continue
            total, mean = means[i, c]
            inertia += total
            updated.append((*mean, *[modes[i, c, j] for j in range(len(cat))]))
        out[run] = (inertia, updated)
    return out


def fit_many(df: DataFrame, kind: str, starts: dict[Hashable, list], numeric: Sequence[str] = (),
             categorical: Sequence[str] = (), gamma: float = 0.8,
             max_iter: int = 100) -> dict[Hashable, ClusterModel]:
    """Advance all runs together until every one has converged."""
    numeric, categorical = list(numeric), list(categorical)
    models = {run: ClusterModel(kind, [tuple(c) for c in s], [tuple(c) for c in s], 0.0, 0, False,
                                numeric, categorical, gamma) for run, s in starts.items()}
    data = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical).persist()
    try:
        for _ in range(max_iter):
            live = {r: m for r, m in models.items() if not m.converged}
            if not live:
                break
            for run, (inertia, updated) in _one_pass(data, live).items():
                m = live[run]
                m.labelling, m.inertia = m.centroids, inertia
                m.iterations += 1
                m.converged = updated == m.centroids
                m.centroids = updated
                m.trace.append({"iteration": m.iterations, "inertia": inertia})
    finally:
        data.unpersist()
    return models


def kmeans(df: DataFrame, cols: Sequence[str], k: int = 3, *, key: Sequence[str] = (), seed: int = 12,
           max_iter: int = 100, start: list | None = None) -> ClusterModel:
    start = start or starting_rows(df, cols, k, key, seed)
    return fit_many(df, "kmeans", {0: start}, numeric=cols, max_iter=max_iter)[0]


def kmodes(df: DataFrame, cols: Sequence[str], k: int = 3, *, key: Sequence[str] = (), seed: int = 12,
           max_iter: int = 100, start: list | None = None) -> ClusterModel:
    start = start or starting_rows(df, cols, k, key, seed)
    return fit_many(df, "kmodes", {0: start}, categorical=cols, max_iter=max_iter)[0]


def pooled_sigma(df: DataFrame, cols: Sequence[str]) -> float:
    """Population sigma of all numeric cells taken together."""
    s = only_row(df.agg(*[f(c).alias(f"{t}{i}") for i, c in enumerate(cols)
                          for t, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))]))
    n = sum(s[f"n{i}"] for i in range(len(cols)))
    mean = sum(s[f"n{i}"] * s[f"m{i}"] for i in range(len(cols))) / n
    var = sum(s[f"n{i}"] * (s[f"v{i}"] + (s[f"m{i}"] - mean) ** 2) for i in range(len(cols))) / n
    return var ** 0.5


def kprototypes(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int = 3, *,
                gamma: float | None = 0.8, key: Sequence[str] = (), seed: int = 12,
                max_iter: int = 100, start: list | None = None) -> ClusterModel:
    """Mixed data; ``gamma=None`` is half the sigma of the numeric block."""
    gamma = 0.5 * pooled_sigma(df, numeric) if gamma is None else gamma
    start = start or starting_rows(df, [*numeric, *categorical], k, key, seed)
    return fit_many(df, "kprototypes", {0: start}, numeric, categorical, gamma, max_iter)[0]


# ---- fuzzy c-means -------------------------------------------------------------
def _membership(cols: Sequence[str], centroids: Sequence[Sequence[float]], m: float) -> Column:
    """u_i = d_i^(-2/(m-1)) / sum_j d_j^(-2/(m-1)), distances floored at eps."""
    power = -2.0 / (m - 1)
    w = [F.pow(F.greatest(V.euclidean(list(cols), [F.lit(float(v)) for v in c]),
                          F.lit(2.220446049250313e-16)), F.lit(power)) for c in centroids]
    total = w[0]
    for x in w[1:]:
        total = total + x
    return F.array(*[x / total for x in w])


def memberships(df: DataFrame, cols: Sequence[str], centroids, m: float = 2.0,
                name: str = "u") -> DataFrame:
    return df.withColumn(name, _membership(cols, centroids, m))


def defuzzify(df: DataFrame, u: str = "u", label: str = "cluster") -> DataFrame:
    """Label of the largest membership."""
    return df.withColumn(label, (F.array_position(u, F.array_max(u)) - 1).cast("int"))


def fuzzy_cmeans(df: DataFrame, cols: Sequence[str], k: int = 3, *, m: float = 2.0, tol: float = 0.01,
                 max_iter: int = 100, key: Sequence[str] = (), seed: int = 12,
                 start: list | None = None, random_memberships: bool = False) -> ClusterModel:
    """Stops when no membership moves by more than ``tol``; ``trace`` keeps the
    mean and largest change of every iteration."""
    cols = list(cols)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols], *[c for c in key if c not in cols])
    data = data.persist()

    def weighted(u: Column):
        return [F.sum(F.pow(F.get(u, F.lit(i)), F.lit(float(m))) * x).alias(f"w{i}_{j}")
                for i in range(k) for j, x in enumerate([*map(F.col, cols), F.lit(1.0)])]

    def update(row) -> list[tuple]:
        return [tuple(row[f"w{i}_{j}"] / row[f"w{i}_{len(cols)}"] for j in range(len(cols)))
                for i in range(k)]

    try:
        trace = []
        if random_memberships:  # seeded hash memberships, rows summing to 1
            raw = [F.pmod(F.xxhash64(*key, F.lit(seed), F.lit(i)), F.lit(1_000_003)) + 1 for i in range(k)]
            total = sum(raw[1:], raw[0])
            old = update(only_row(data.select(*cols, F.array(*[r / total for r in raw]).alias("u"))
                                  .agg(*weighted(F.col("u")))))
        else:
            old = [tuple(c) for c in (start or starting_rows(data, cols, k, key, seed))]
        new = update(only_row(memberships(data, cols, old, m).agg(*weighted(F.col("u")))))
        iterations, converged, inertia = 0, False, 0.0
        for iterations in range(1, max_iter + 1):
            both = memberships(memberships(data, cols, old, m, "u_old"), cols, new, m)
            change = F.zip_with("u", "u_old", lambda a, b: F.abs(a - b))
            row = only_row(both.agg(
                F.max(F.array_max(change)).alias("max_change"),
                F.avg(F.aggregate(change, F.lit(0.0), lambda a, b: a + b) / F.lit(float(k))).alias("mean_change"),
                F.sum(F.array_min("u")).alias("inertia"), *weighted(F.col("u"))))
            inertia = row["inertia"]
            trace.append({"iteration": iterations, "max_change": row["max_change"],
                          "mean_change": row["mean_change"]})
            labelling = new
            if row["max_change"] <= tol:
                converged = True
                break
            old, new = new, update(row)
    finally:
        data.unpersist()
    return ClusterModel("fuzzy", labelling, labelling, inertia, iterations, converged, cols,
                        fuzzifier=m, trace=trace)


def membership_change(df: DataFrame, model: ClusterModel) -> DataFrame:
    """Termination trace as a table."""
    return df.sparkSession.createDataFrame(
        [(t["iteration"], t["max_change"], t["mean_change"]) for t in model.trace],
        "iteration int, max_change double, mean_change double")


# ---- dispatch and model search --------------------------------------------------
CLUSTERERS: dict[str, dict] = {
    "kmeans": {"fit": kmeans, "metric": "euclidean"},
    "kmodes": {"fit": kmodes, "metric": "hamming"},
    "kprototypes": {"fit": kprototypes, "metric": "manhattan"},
    "fuzzy": {"fit": fuzzy_cmeans, "metric": "euclidean"},
    "agglomerative": {"fit": agglomerative, "metric": "euclidean"},
}


def make_clusterer(alg: str) -> tuple[Callable, str]:
    """Name to (fit function, silhouette metric)."""
    if alg not in CLUSTERERS:
        raise ValueError(f"unknown algorithm {alg!r}; one of {sorted(CLUSTERERS)}")
    entry = CLUSTERERS[alg]
    return entry["fit"], entry["metric"]


def label_all_runs(df: DataFrame, models: dict[Hashable, ClusterModel]) -> DataFrame:
    """One row per input row and run: (..., run, cluster, distance)."""
    cells = [F.struct(F.lit(run).alias("run"), _distances(m, m.labelling).alias("_d"))
             for run, m in models.items()]
    d = F.col("_d")
    return df.select("*", F.inline(F.array(*cells))).select(
        "*", (F.array_position(d, F.array_min(d)) - 1).cast("int").alias("cluster"),
        F.array_min(d).alias("distance")).drop("_d")


def elbow(df: DataFrame, ks: Sequence[int], *, kind: str = "kmeans", numeric: Sequence[str] = (),
          categorical: Sequence[str] = (), key: Sequence[str] = (), seed: int = 42,
          max_iter: int = 100, starts: dict | None = None) -> DataFrame:
    """Inertia per k; every k advances in the same passes."""
    cols = [*numeric, *categorical]
    if starts is None:
        rows = starting_rows(df, cols, max(ks), key, seed)
        starts = {k: rows[:k] for k in ks}
    models = fit_many(df, kind, starts, numeric, categorical, max_iter=max_iter)
    return df.sparkSession.createDataFrame(
        [(int(k), float(m.inertia), m.iterations) for k, m in models.items()],
        "k int, inertia double, iterations int")


def seed_scores(df: DataFrame, seeds: Sequence[int], k: int, truth: str, *, kind: str = "kmeans",
                numeric: Sequence[str] = (), categorical: Sequence[str] = (), key: Sequence[str] = (),
                max_iter: int = 100) -> DataFrame:
    """Adjusted Rand index of every seed, all from one labelled table."""
    from tabulon.operators.metrics import adjusted_rand
    cols = [*numeric, *categorical]
    starts = {s: starting_rows(df, cols, k, key, s) for s in seeds}
    models = fit_many(df, kind, starts, numeric, categorical, max_iter=max_iter)
    return adjusted_rand(label_all_runs(df, models), truth, "cluster", by=["run"]).withColumnRenamed("run", "seed")


def best_seed(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("adjusted_rand"), "seed").limit(1)


def silhouette_sweep(df: DataFrame, ks: Sequence[int], cols: Sequence[str], *, key: str,
                     metric: str = "euclidean", seed: int = 10, max_iter: int = 100) -> DataFrame:
    """Average per k and per cluster over one joint fit of all k."""
    from tabulon.operators.metrics import silhouette_samples
    rows = starting_rows(df, cols, max(ks), [key], seed)
    models = fit_many(df, "kmeans", {k: rows[:k] for k in ks}, numeric=cols, max_iter=max_iter)
    out = None
    for k, m in models.items():
        part = (silhouette_samples(m.predict(df), key, cols, "cluster", metric)
                .groupBy("cluster").agg(F.sum("silhouette").alias("_s"), F.count("*").alias("n"))
                .withColumn("k", F.lit(int(k))))
        out = part if out is None else out.unionByName(part)
    sets = out.groupingSets([["k", "cluster"], ["k"]], "k", "cluster").agg(
        F.sum("n").alias("n"), (F.sum("_s") / F.sum("n")).alias("silhouette"))
    return sets
