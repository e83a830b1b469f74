"""Clustering and classification metrics (the M family).

Label metrics are computed from the contingency table (k x k rows after one
partial aggregate); the marginals come from grouping sets over that table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions import vectors as V
from tabulon.functions.scale import bounded_rows, cut_lineage, only_row

MAX_LABELS = 10_000
#: Most rows of a block that is compared in one task, and least rows that make a block of their own.
BLOCK_ROWS, MIN_BLOCK_ROWS = 32_768, 256


def contingency(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, truth, pred).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: list) -> DataFrame:
    """Rows are true classes, one column per predicted class."""
    return (df.groupBy(truth).pivot(pred, classes).agg(F.count(F.lit(1)))
            .na.fill(0))


def _margins(df: DataFrame, truth: str, pred: str, by: Sequence[str]) -> DataFrame:
    """Cell, row, column and grand totals tagged by ``_g`` (0 cell, 1 row,
    2 column, 3 all)."""
    table = contingency(df, truth, pred, by)
    sets = [[*by, truth, pred], [*by, truth], [*by, pred], [*by]]
    return table.groupingSets(sets, *by, truth, pred).agg(
        F.sum("n").alias("n"),
        (F.grouping(truth).cast("int") * 2 + F.grouping(pred).cast("int")).alias("_g"))


def purity(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    best = contingency(df, truth, pred, by).groupBy(*by, pred).agg(
        F.max("n").alias("_best"), F.sum("n").alias("_n"))
    return best.groupBy(*by).agg((F.sum("_best") / F.sum("_n")).alias("purity"))


def adjusted_rand(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    pairs = F.col("n") * (F.col("n") - 1) / 2
    g = F.col("_g")
    sums = _margins(df, truth, pred, by).groupBy(*by).agg(
        F.sum(F.when(g == 0, pairs).otherwise(0.0)).alias("s"),
        F.sum(F.when(g == 1, pairs).otherwise(0.0)).alias("a"),
        F.sum(F.when(g == 2, pairs).otherwise(0.0)).alias("b"),
        F.sum(F.when(g == 3, pairs).otherwise(0.0)).alias("t"))
    expected = F.col("a") * F.col("b") / F.col("t")
    best = (F.col("a") + F.col("b")) / 2
    return sums.select(*by, F.when(best == expected, F.lit(1.0)).otherwise(
        (F.col("s") - expected) / (best - expected)).alias("adjusted_rand"))


def _ln_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series of ln gamma at n + 1 shifted up by 10."""
    x = n.cast("double") + 11.0
    z = 1.0 / (x * x)
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + (
        1.0 / 12 - z * (1.0 / 360 - z * (1.0 / 1260 - z * (1.0 / 1680)))) / x
    shift = F.lit(0.0)
    for i in range(1, 11):
        shift = shift + F.log(n.cast("double") + i)
    return series - shift


def adjusted_mutual_info(df: DataFrame, truth: str, pred: str, chunk: int = 65_536) -> DataFrame:
    """Mutual information adjusted for chance, arithmetic normaliser."""
    table = contingency(df, truth, pred)
    rows = table.groupBy(truth).agg(F.sum("n").alias("a"))
    cols = table.groupBy(pred).agg(F.sum("n").alias("b"))
    total = only_row(rows.agg(F.sum("a").alias("t")))["t"]
    a_rows = bounded_rows(rows, MAX_LABELS, "true classes")
    b_rows = bounded_rows(cols, MAX_LABELS, "clusters")
    t = F.lit(float(total))
    joined = table.join(rows, truth).join(cols, pred)
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    mi = only_row(joined.agg(F.sum(n / t * F.log(n * t / (a * b))).alias("mi")))["mi"]

    def entropy(totals: list[int]) -> float:
        import math
        return -sum(x / total * math.log(x / total) for x in totals)

    h_true, h_pred = entropy([r["a"] for r in a_rows]), entropy([r["b"] for r in b_rows])
    # expected MI: every possible cell count of every (row, column) total, made
    # on the executors; equal totals share one line with a multiplicity
    def tally(values):
        out = {}
        for v in values:
            out[v] = out.get(v, 0) + 1
        return list(out.items())
    spark = df.sparkSession
    left = F.lit([x for x, _ in tally([r["a"] for r in a_rows])]).cast("array<bigint>")
    left_n = F.lit([c for _, c in tally([r["a"] for r in a_rows])]).cast("array<bigint>")
    pairs = spark.createDataFrame(tally([r["b"] for r in b_rows]), "b bigint, b_n bigint").select(
        "b", "b_n", F.explode(F.arrays_zip(left.alias("a"), left_n.alias("a_n"))).alias("_l")).select(
        "b", "b_n", F.col("_l.a").alias("a"), F.col("_l.a_n").alias("a_n"))
    lo, hi = F.greatest(F.lit(1), a + b - total), F.least(a, b)
    cells = (pairs.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((hi - lo) / chunk))).alias("_c"))
             .repartition("a", "b", "_c")
             .select("a", "b", (F.col("a_n") * F.col("b_n")).alias("w"), F.explode(F.sequence(
                 lo + F.col("_c") * chunk, F.least(hi, lo + (F.col("_c") + 1) * chunk - 1))).alias("n")))
    ln_p = (_ln_factorial(a) + _ln_factorial(b) + _ln_factorial(total - a) + _ln_factorial(total - b)
            - _ln_factorial(F.lit(total)) - _ln_factorial(n) - _ln_factorial(a - n)
            - _ln_factorial(b - n) - _ln_factorial(total - a - b + n))
    emi = cells.agg(F.sum(F.col("w") * n / t * F.log(n * t / (a * b)) * F.exp(ln_p)).alias("emi"))
    norm = (h_true + h_pred) / 2
    return emi.select(
        F.lit(mi).alias("mutual_info"), F.lit(h_true).alias("entropy_true"),
        F.lit(h_pred).alias("entropy_pred"), F.col("emi").alias("expected_mutual_info"),
        F.when(F.lit(norm) == F.col("emi"), F.lit(1.0)).otherwise(
            (F.lit(mi) - F.col("emi")) / (F.lit(norm) - F.col("emi"))).alias("adjusted_mutual_info"))


# ---- silhouette ------------------------------------------------------------------
def _cluster_sizes(df: DataFrame, label: str) -> dict:
    rows = bounded_rows(df.groupBy(label).agg(F.count("*").alias("n")), MAX_LABELS, "clusters")
    return {r[label]: r["n"] for r in sorted(rows, key=lambda r: r[label])}


def _silhouette_from_sums(df: DataFrame, label: str, sums: list[Column], sizes: dict) -> DataFrame:
    """``sums[i]`` is the summed distance of a row to all rows of cluster i."""
    names = list(sizes)
    own_sum, own_n, other = F.lit(None).cast("double"), F.lit(None).cast("double"), []
    for i, c in enumerate(names):
        mine = F.col(label) == F.lit(c)
        own_sum = F.when(mine, sums[i]).otherwise(own_sum)
        own_n = F.when(mine, F.lit(float(sizes[c]))).otherwise(own_n)
        other.append(F.when(~mine, sums[i] / float(sizes[c])))
    out = df.withColumn("_n", own_n).withColumn("_a", own_sum / F.greatest(own_n - 1, F.lit(1.0)))
    out = out.withColumn("_b", F.array_min(F.array(*other)))
    top = F.greatest("_a", "_b")
    return out.withColumn("silhouette", F.when((F.col("_n") <= 1) | (top == 0), F.lit(0.0)).otherwise(
        (F.col("_b") - F.col("_a")) / top)).drop("_n", "_a", "_b")


def _level_table(df: DataFrame, cols: Sequence[str], label: str, sizes: dict, dtype: str) -> DataFrame:
    """One row per column and distinct value with its count in every cluster."""
    cells = [F.struct(F.lit(j).alias("dim"), F.col(c).cast(dtype).alias("value")) for j, c in enumerate(cols)]
    return df.select(label, F.inline(F.array(*cells))).groupBy("dim", "value").agg(
        *[F.count_if(F.col(label) == F.lit(c)).alias(f"n{i}") for i, c in enumerate(sizes)])


def _hamming_sums(table: DataFrame, sizes: dict, d: int) -> DataFrame:
    return table.select("dim", "value", *[((F.lit(n) - F.col(f"n{i}")) / float(d)).alias(f"s{i}")
                                          for i, n in enumerate(sizes.values())])


def _manhattan_sums(table: DataFrame, sizes: dict, buckets: int) -> DataFrame:
    """sum |x - y| over the rows y of every cluster, for every distinct x, from
    prefix counts and sums; windows run inside value ranges of bounded size."""
    k = len(sizes)
    probs = [i / buckets for i in range(1, buckets)]
    # range edges: a bounded array per column
    edges = {r["dim"]: np.unique(r["e"]) for r in table.groupBy("dim").agg(
        F.percentile_approx("value", F.lit(probs), 100 * buckets).alias("e")).collect()}

    @F.pandas_udf("int")
    def bucket_of(dim: pd.Series, value: pd.Series) -> pd.Series:
        out = np.zeros(len(dim), dtype="int32")
        for j, e in edges.items():
            mine = dim.to_numpy() == j
            out[mine] = np.searchsorted(e, value.to_numpy()[mine], side="left")
        return pd.Series(out)

    placed = table.withColumn("_bucket", bucket_of("dim", "value"))
    before = Window.partitionBy("dim").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("dim")
    totals = placed.groupBy("dim", "_bucket").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(k)],
        *[F.sum(F.col(f"n{i}") * F.col("value")).alias(f"t{i}") for i in range(k)])
    totals = totals.select("dim", "_bucket", *[
        F.coalesce(F.sum(f"{t}{i}").over(w), F.lit(0)).alias(f"_{t}{i}_{tag}")
        for i in range(k) for t in "nt" for tag, w in (("lo", before), ("all", whole))])
    w = Window.partitionBy("dim", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    out, x = [], F.col("value")
    for i in range(k):
        n_le = F.sum(f"n{i}").over(w) + F.col(f"_n{i}_lo")
        t_le = F.sum(F.col(f"n{i}") * x).over(w) + F.col(f"_t{i}_lo")
        n_gt, t_gt = F.col(f"_n{i}_all") - n_le, F.col(f"_t{i}_all") - t_le
        out.append((x * n_le - t_le + t_gt - x * n_gt).alias(f"s{i}"))
    return placed.join(F.broadcast(totals), ["dim", "_bucket"]).select("dim", "value", *out)


def _additive_silhouette(df: DataFrame, cols: Sequence[str], label: str, metric: str,
                         buckets: int) -> DataFrame:
    """Metrics that add up over columns need no pairs of rows: every column
    contributes through a table keyed by its distinct values."""
    sizes = _cluster_sizes(df, label)
    dtype = "string" if metric == "hamming" else "double"
    levels = _level_table(df, cols, label, sizes, dtype)
    if metric == "hamming":
        sums = cut_lineage(_hamming_sums(levels, sizes, len(cols)))
    else:
        sums = cut_lineage(_manhattan_sums(cut_lineage(levels), sizes, buckets))
    out = df
    for j, c in enumerate(cols):
        part = sums.where(F.col("dim") == j).drop("dim").toDF(
            f"_v{j}", *[f"_s{j}_{i}" for i in range(len(sizes))])
        out = out.join(part, F.col(c).cast(dtype) == F.col(f"_v{j}"), "left").drop(f"_v{j}")
    totals = []
    for i in range(len(sizes)):
        total = F.col(f"_s0_{i}")
        for j in range(1, len(cols)):
            total = total + F.col(f"_s{j}_{i}")
        totals.append(total)
    scored = _silhouette_from_sums(out, label, totals, sizes)
    return scored.drop(*[f"_s{j}_{i}" for j in range(len(cols)) for i in range(len(sizes))])


def _distance_tiles(x: np.ndarray, left: np.ndarray, right: np.ndarray):
    """(rows, rows, distances) of all pairs of both sides, a tile at a time: by one
    matrix product, and by the differences where rows are so near that the product
    would lose digits."""
    a = x - x.mean(0)
    norm = (a * a).sum(-1)
    one = np.ones(len(x))
    wide, tall = np.column_stack([-2 * a, norm, one]), np.column_stack([a, one, norm]).T
    # by norm, so that a tile's largest norm says what is near in it
    left, right = left[np.argsort(norm[left], kind="stable")], right[np.argsort(norm[right], kind="stable")]
    for t in range(0, len(right), 2048):
        other = right[t:t + 2048]
        columns = np.ascontiguousarray(tall[:, other])
        for s in range(0, len(left), 128):
            some = left[s:s + 128]
            square = wide[some] @ columns
            near = np.flatnonzero(~(square > 1e-4 * (norm[some].max() + norm[other].max())))
            for n in range(0, len(near), 16_384):
                i, j = np.divmod(near[n:n + 16_384], len(other))
                diff = x[some[i]] - x[other[j]]
                square[i, j] = (diff * diff).sum(-1)
            yield some, other, np.sqrt(square, out=square)


def _euclidean_silhouette(df: DataFrame, key: str, cols, label: str, block_rows: int) -> DataFrame:
    """Exact for any number of rows; the work is quadratic by definition.

    Rows are hashed into g blocks and every pair of blocks is one task, which
    adds up both sides: a row is copied g times and has g partial sums for each
    cluster.  g grows with the root of the number of tasks, and with the rows
    only where a pair of blocks would not fit a task."""
    sizes = _cluster_sizes(df, label)
    names, n = list(sizes), sum(sizes.values())
    tasks = 8 * df.sparkSession.sparkContext.defaultParallelism  # half of a grid is used
    g = max(1, -(-n // block_rows), min(math.isqrt(tasks), n // MIN_BLOCK_ROWS))
    feats = (F.array(*[F.col(c).cast("double") for c in cols]) if not isinstance(cols, str)
             else F.col(cols).cast("array<double>"))
    cluster = F.array_position(F.lit(names), F.col(label)) - 1
    rows = df.select(F.col(key).alias("_id"), feats.alias("_x"), cluster.cast("int").alias("_c"),
                     F.pmod(F.xxhash64(key), F.lit(g)).cast("int").alias("_b"))
    pairs = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(g - 1)))).select(
        "_id", "_x", "_c", "_b", F.least("_b", "_o").alias("_low"), F.greatest("_b", "_o").alias("_high"))
    k = len(names)
    id_type = df.schema[key].dataType.simpleString()

    def compare(both):
        x, c = np.stack(both["_x"].to_numpy()), both["_c"].to_numpy()
        member = np.zeros((len(x), k))
        member[np.arange(len(x)), c] = 1.0
        out = np.zeros((len(x), k))
        side = both["_b"].to_numpy() == both["_low"].to_numpy()
        left = np.flatnonzero(side)
        right = left if both["_low"].iat[0] == both["_high"].iat[0] else np.flatnonzero(~side)
        for some, other, dist in _distance_tiles(x, left, right):
            out[some] += dist @ member[other]
            if right is not left:
                out[other] += dist.T @ member[some]
        return pd.DataFrame({"_id": both["_id"], **{f"_s{i}": out[:, i] for i in range(k)}})

    schema = f"_id {id_type}, " + ", ".join(f"_s{i} double" for i in range(k))
    parts = pairs.groupBy("_low", "_high").applyInPandas(compare, schema)
    sums = parts.groupBy("_id").agg(*[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(k)])
    joined = df.join(sums.withColumnRenamed("_id", key), key)
    return _silhouette_from_sums(joined, label, [F.col(f"_s{i}") for i in range(k)], sizes).drop(
        *[f"_s{i}" for i in range(k)])


def silhouette_samples(df: DataFrame, key: str, cols, label: str, metric: str = "euclidean", *,
                       block_rows: int = BLOCK_ROWS, buckets: int = 256) -> DataFrame:
    """(b - a) / max(a, b) per row; a singleton cluster gives 0."""
    if metric == "euclidean":
        return _euclidean_silhouette(df, key, cols, label, block_rows)
    if metric in ("manhattan", "hamming"):
        return _additive_silhouette(df, cols, label, metric, buckets)
    raise ValueError(f"unknown metric {metric!r}")


def silhouette_score(df: DataFrame, key: str, cols, label: str, metric: str = "euclidean", **kw) -> DataFrame:
    return silhouette_samples(df, key, cols, label, metric, **kw).agg(
        F.avg("silhouette").alias("silhouette"))


def davies_bouldin(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Mean over clusters of the largest (s_i + s_j) / d_ij."""
    cols = list(cols)
    centres = {r[label]: [r[c] for c in cols] for r in bounded_rows(
        df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols]), MAX_LABELS, "clusters")}
    names = sorted(centres)
    dist = F.lit(None).cast("double")
    for c in names:
        dist = F.when(F.col(label) == F.lit(c), V.euclidean(cols, [F.lit(v) for v in centres[c]])).otherwise(dist)
    spread = df.groupBy(label).agg(F.avg(dist).alias("s"))
    one = spread.agg(*[F.max(F.when(F.col(label) == F.lit(c), F.col("s"))).alias(f"s{i}")
                       for i, c in enumerate(names)])
    worst = []
    for i, a in enumerate(names):
        ratios = []
        for j, b in enumerate(names):
            if i != j:
                gap = sum((x - y) ** 2 for x, y in zip(centres[a], centres[b])) ** 0.5
                if gap > 0:
                    ratios.append((F.col(f"s{i}") + F.col(f"s{j}")) / gap)
        worst.append(F.array_max(F.array(*ratios)) if ratios else F.lit(0.0))
    total = worst[0]
    for w in worst[1:]:
        total = total + w
    return one.select((total / float(len(names))).alias("davies_bouldin"))


# ---- label matching and classification ----------------------------------------------
def match_labels(df: DataFrame, truth: str, pred: str) -> dict:
    """Predicted label -> true class, greedily: every class in order takes its
    most frequent predicted label not taken before (the smallest on a tie)."""
    rows = bounded_rows(contingency(df, truth, pred), MAX_LABELS, "contingency cells")
    mapping: dict = {}
    for c in sorted({r[truth] for r in rows if r[truth] is not None}):
        options = [(-r["n"], r[pred]) for r in rows if r[truth] == c and r[pred] not in mapping]
        if options:
            mapping[min(options)[1]] = c
    return mapping


def rename_labels(df: DataFrame, truth: str, pred: str, mapping: dict | None = None) -> DataFrame:
    mapping = match_labels(df, truth, pred) if mapping is None else mapping
    dtype = df.schema[truth].dataType
    out = F.col(pred).cast(dtype)
    for p, c in mapping.items():
        out = F.when(F.col(pred) == F.lit(p), F.lit(c).cast(dtype)).otherwise(out)
    return df.withColumn(pred, out)


def f_measure(df: DataFrame, truth: str, pred: str, positive=1) -> DataFrame:
    """Micro-averaged for more than two classes, of the positive class for two."""
    classes = df.select(truth).distinct().limit(3).count()
    hit = F.col(truth) == F.col(pred)
    if classes > 2:
        return df.agg(F.avg(hit.cast("double")).alias("f_measure"))
    tp = F.count_if(hit & (F.col(truth) == F.lit(positive)))
    marked = F.count_if(F.col(truth) == F.lit(positive)) + F.count_if(F.col(pred) == F.lit(positive))
    return df.agg((F.lit(2.0) * tp / marked).alias("f_measure"))


def accuracy(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"))


def cluster_report(df: DataFrame, truth: str, pred: str, cols: Sequence[str], key: str,
                   metric: str = "euclidean") -> DataFrame:
    """ARI, purity, Davies-Bouldin, F and silhouette as one row.

    Every part is a single value; each runs as its own small aggregate."""
    parts = {
        "ars": adjusted_rand(df, truth, pred), "purity": purity(df, truth, pred),
        "db": davies_bouldin(df, cols, pred),
        "f_measure": f_measure(rename_labels(df, truth, pred), truth, pred),
        "silhouette": silhouette_score(df, key, cols, pred, metric)}
    values = {name: only_row(part)[0] for name, part in parts.items()}
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in values])
    return df.sparkSession.createDataFrame([tuple(float(v) for v in values.values())], schema)


def r2(df: DataFrame, truth: str, pred: str) -> DataFrame:
    err = F.col(truth) - F.col(pred)
    return df.agg((1 - F.sum(err * err) / (F.var_pop(truth) * F.count(truth))).alias("r2"))
