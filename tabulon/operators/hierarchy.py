"""Agglomerative clustering, exact for any number of rows (U8).

Equal rows are one weighted point.  Single linkage is the minimum spanning tree:
in every round each component finds its nearest point outside (an exact
neighbour search that skips the own component) and all components merge along
these edges, so rounds grow with the logarithm of the points.

Average, complete and Ward linkage are reducible: pairs of clusters that are
each other's nearest may be merged at once without changing the hierarchy.  For
average and complete linkage of euclidean distances, centroids bound the
linkages: a search among centroids gives each cluster the few others that can be
its nearest, and only their linkages are worked out from the points.  Else the
linkages of all pairs are a table (quadratic, as the definition is); a round
takes each cluster's nearest from it and folds the rows of merged clusters
together.  The last ``LAST`` clusters are merged in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.scale import bounded_rows, scratch_path, with_ordinal
from tabulon.operators.neighbours import knn

LINKAGES = ("single", "complete", "average", "ward")
#: Clusters whose remaining merges one task works out, and most clusters of a result.
LAST, MAX_CLUSTERS = 500, 10_000
#: Most points of a block whose pairs one task lists.
BLOCK_ROWS = 4096
#: Numbers of the vectors that one row of packed points holds, centroids found at first, and how far off their distances can be.
PACKED, NEAR, SLACK = 1024, 8, 1e-8
_MERGES = "a long, b long, height double, step long"


def _written(df: DataFrame) -> DataFrame:
    """A table in the shared folder, read back.  Rounds join tables that come of
    joins; a checkpoint would keep the planner's size of each, their product."""
    path = scratch_path(df.sparkSession, "hierarchy")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root): the least node that each of ``nodes`` (id) reaches over
    ``edges`` (a, b).  Labels go to neighbours and then jump along themselves."""
    both = _written(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a")))
    labels = _written(nodes.select("id", F.col("id").alias("root")))
    while True:
        told = both.join(labels, both["y"] == labels["id"]).groupBy("x").agg(F.min("root").alias("low"))
        met = labels.join(told, labels["id"] == told["x"], "left").select(
            "id", F.col("root").alias("old"), F.least("root", "low").alias("root"))
        of = met.select(F.col("id").alias("r"), F.col("root").alias("jump"))
        labels = _written(met.join(of, F.col("root") == F.col("r")).select("id", "old", F.col("jump").alias("root")))
        if labels.where(F.col("old") != F.col("root")).isEmpty():
            return labels.select("id", "root")
        labels = labels.select("id", "root")


def spanning_tree(points: DataFrame) -> DataFrame:
    """Edges (a, b, height) of the minimum spanning tree of ``points`` (id, x),
    with ties by the ids."""
    placed = _written(points.select("id", "x", F.col("id").alias("c")))
    found = None
    while True:
        near = knn(placed, placed, 1, 2, key="id", features="x", label="c", exclude="c")
        own = placed.select(F.col("id").alias("test_id"), F.col("c").alias("own"))
        edge = F.struct("distance", F.least("test_id", "train_id").alias("a"), F.greatest("test_id", "train_id").alias("b"), "label")
        # edges have a total order, so chosen ones make no cycle but the edge that two choose both
        best = _written(near.where(F.col("train_id").isNotNull()).join(own, "test_id").groupBy("own").agg(F.min(edge).alias("e")).select(
            "own", F.col("e.label").alias("to"), F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("e.distance").alias("height")))
        if best.isEmpty():
            return found
        edges = best.select("a", "b", "height").distinct()
        found = edges if found is None else found.unionByName(edges)
        merged = components(best.select(F.col("own").alias("id")), best.select(F.col("own").alias("a"), F.col("to").alias("b")))
        placed = _written(placed.join(merged.withColumnRenamed("id", "c"), "c").select("id", "x", F.col("root").alias("c")))


def pair_table(points: DataFrame, affinity: str = "euclidean") -> DataFrame:
    """(a, b, m) with a < b: distances of all pairs of ``points`` (id, x), listed
    by pairs of blocks."""
    n = points.count()
    tasks = 8 * points.sparkSession.sparkContext.defaultParallelism
    g = max(1, -(-n // BLOCK_ROWS), min(math.isqrt(tasks), n // 64))
    rows = points.select("id", "x", F.pmod(F.xxhash64("id"), F.lit(g)).cast("int").alias("g"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(g - 1)))).select(
        "id", "x", "g", F.least("g", "o").alias("low"), F.greatest("g", "o").alias("high"))

    def listed(frame: pd.DataFrame) -> pd.DataFrame:
        ids, x = frame["id"].to_numpy(), np.stack(frame["x"].to_numpy())
        one = frame["low"].iat[0] == frame["high"].iat[0]
        left = np.arange(len(ids)) if one else np.flatnonzero(frame["g"] == frame["low"])
        right = left if one else np.flatnonzero(frame["g"] == frame["high"])
        a, b, m = [], [], []
        for i in left.tolist():
            some = right[ids[right] > ids[i]] if one else right
            if affinity == "cosine":
                norms = np.linalg.norm(x[i]) * np.linalg.norm(x[some], axis=1)
                d = 1 - (x[some] @ x[i]) / np.where(norms > 0, norms, 1)
            else:
                d = np.sqrt(((x[some] - x[i]) ** 2).sum(-1))
            a.append(np.minimum(ids[i], ids[some]))
            b.append(np.maximum(ids[i], ids[some]))
            m.append(d)
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "m": np.concatenate(m)})

    return rows.groupBy("low", "high").applyInPandas(listed, "a long, b long, m double")


def _linkage(linkage: str, m, na, nb, wa, wb):
    """Linkage of two clusters from ``m`` (the largest, mean or mean squared
    distance of their rows), their sizes and variances."""
    return na * nb / (na + nb) * (m - wa - wb) if linkage == "ward" else m


def merge_rounds(points: DataFrame, pairs: DataFrame, linkage: str) -> DataFrame:
    """Merges (a, b, height, step) of the whole hierarchy of ``points`` (id, n);
    a cluster is named by its least point, and b merges into a."""
    size = lambda side: points.select(F.col("id").alias(side), F.col("n").cast("double").alias(f"n{side}"))
    m = F.col("m") * F.col("m") if linkage == "ward" else F.col("m")
    table = _written(pairs.join(size("a"), "a").join(size("b"), "b").select(
        "a", "b", m.alias("m"), "na", "nb", F.lit(0.0).alias("wa"), F.lit(0.0).alias("wb")))
    left, step, found = points.count(), 0, None
    value = _linkage(linkage, *[F.col(c) for c in ("m", "na", "nb", "wa", "wb")])
    while left > LAST:
        edge = F.struct(value.alias("v"), "a", "b", "na", "nb", "wa", "wb").alias("e")
        near = table.select(edge, F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.min("e").alias("e"))
        # what both ends choose; the least edge of all is always one
        merges = _written(near.groupBy("e.a", "e.b").agg(F.count("*").alias("k"), F.first("e").alias("e")).where("k = 2").select(
            "a", "b", F.col("e.v").alias("height"), (F.col("e.na") + F.col("e.nb")).alias("n"),
            ((F.col("e.na") * F.col("e.wa") + F.col("e.nb") * F.col("e.wb") + F.col("e.v")) / (F.col("e.na") + F.col("e.nb"))).alias("w")))
        done = merges.count()
        found = _union(found, merges.select("a", "b", "height", F.lit(step).cast("long").alias("step")))
        table = _written(_folded(table, merges, linkage))
        left, step = left - done, step + 1
    last = table.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda rows: _finish(rows, linkage, step), _MERGES)
    return _union(found, last)


def _unit(points: DataFrame) -> list[tuple[float, float]] | None:
    """(least value, widest range) of every coordinate of ``points`` (x); None
    where a range is not finite."""
    dims = points.select(F.size("x").alias("d")).first()["d"]
    at = [F.get("x", F.lit(i)) for i in range(dims)]
    ends = points.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(at) for f in (F.min, F.max)]).first()
    wide = max(ends[f"max{i}"] - ends[f"min{i}"] for i in range(dims))
    return [(ends[f"min{i}"], wide) for i in range(dims)] if math.isfinite(wide) else None


def merge_near(points: DataFrame, unit: list[tuple[float, float]], linkage: str) -> DataFrame:
    """As ``merge_rounds`` for average and complete linkage of the euclidean
    distances of ``points`` (id, x, n), without a table of all pairs."""
    members = _written(points.select(F.col("id").alias("p"), "x", F.col("n").cast("double").alias("n"), F.col("id").alias("c")))
    z = F.array(*[(F.get("x", F.lit(i)) - low) / wide for i, (low, wide) in enumerate(unit)])
    # centroid, mean squared distance of the points to it, and a radius that holds them
    clusters = _written(points.select("id", F.col("n").cast("double").alias("n"), z.alias("z"), F.lit(0.0).alias("w"), F.lit(0.0).alias("r")))
    left, step, found = clusters.count(), 0, None
    while left > LAST:
        met = _written(_linkages(_candidates(clusters, left, linkage), members, len(unit), linkage))
        near = met.select(F.struct(F.col("m").alias("v"), "a", "b").alias("e"), F.explode(F.array("a", "b")).alias("c")).groupBy(
            "c").agg(F.min("e").alias("e"))
        merges = _written(near.groupBy("e.a", "e.b").agg(F.count("*").alias("k"), F.first("e.v").alias("height")).where("k = 2").select(
            "a", "b", "height"))
        found = _union(found, merges.select("a", "b", "height", F.lit(step).cast("long").alias("step")))
        left, step = left - merges.count(), step + 1
        into = merges.select(F.col("b").alias("old"), F.col("a").alias("new"))
        members = _written(members.join(into, F.col("c") == F.col("old"), "left").select("p", "x", "n", F.coalesce("new", "c").alias("c")))
        clusters = _written(_joined(clusters, merges))
    one = clusters.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("w").alias("wa"))
    other = clusters.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("w").alias("wb"))
    pairs = one.join(other, F.col("a") < F.col("b"))
    table = _linkages(pairs.select("a", "b"), members, len(unit), linkage).join(one, "a").join(other, "b")
    last = table.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda rows: _finish(rows, linkage, step), _MERGES)
    return _union(found, last)


def _candidates(clusters: DataFrame, left: int, linkage: str) -> DataFrame:
    """(a, b): for each cluster at least the pair with its nearest one.  No
    linkage is below the distance of the centroids, and none above what mean
    squares (average) or radii (complete) add to it."""
    own = clusters.select(F.col("id").alias("test_id"), F.col("w").alias("wa"), F.col("r").alias("ra"))
    other = clusters.select(F.col("id").alias("train_id"), F.col("w").alias("wb"), F.col("r").alias("rb"))
    most = F.col("distance") + F.col("ra") + F.col("rb") if linkage == "complete" else F.sqrt(
        F.col("distance") * F.col("distance") + F.col("wa") + F.col("wb"))
    k, todo, found = min(NEAR, left - 1), clusters, None
    while True:
        near = knn(clusters, todo, k, 2, key="id", features="z", label="id", exclude="id").drop("label")
        near = _written(near.join(own, "test_id").join(other, "train_id").select("test_id", "train_id", "distance", most.alias("most")))
        reach = near.groupBy("test_id").agg((F.min("most") * (1 + SLACK) + SLACK).alias("reach"), F.max("distance").alias("far"))
        reach = _written(reach.withColumn("done", (F.col("far") > F.col("reach")) | F.lit(k == left - 1)))
        pairs = near.join(reach.where("done"), "test_id").where("distance <= reach").select(
            F.least("test_id", "train_id").alias("a"), F.greatest("test_id", "train_id").alias("b"))
        found = _union(found, pairs)
        open_ = reach.where("not done").select(F.col("test_id").alias("id"))
        if open_.isEmpty():
            return found.distinct()
        todo, k = _written(clusters.join(open_, "id", "left_semi")), min(k * NEAR, left - 1)


def _linkages(pairs: DataFrame, members: DataFrame, dims: int, linkage: str) -> DataFrame:
    """(a, b, m): the mean or largest distance of the points of two clusters for
    ``pairs`` (a, b).  Points travel packed, and a large cluster in many packs."""
    context = pairs.sparkSession.sparkContext
    held = members.groupBy("c").agg(F.count("*").alias("held"))
    pack = F.pmod(F.xxhash64("p"), F.ceil(F.col("held") / max(1, PACKED // dims)).cast("long"))
    packs = members.join(held, "c").groupBy("c", pack.alias("pack")).agg(F.collect_list(F.struct("x", "n")).alias("s"))
    packs = _written(packs.select("c", F.flatten("s.x").alias("x"), F.col("s.n").alias("n")))
    side = lambda s: packs.select(F.col("c").alias(s), F.col("x").alias(f"x{s}"), F.col("n").alias(f"n{s}"))
    # the work is in the pairs, however few bytes they are
    dealt = pairs.repartition(2 * context.defaultParallelism, "a", "b")

    def measured(frames):
        for f in frames:
            m, w = np.empty(len(f)), np.empty(len(f))
            for i, (x, n, y, o) in enumerate(zip(f["xa"], f["na"], f["xb"], f["nb"])):
                d = x.reshape(-1, 1, dims) - y.reshape(1, -1, dims)
                d = np.sqrt((d ** 2).sum(-1))
                w[i] = n.sum() * o.sum()
                m[i] = d.max() if linkage == "complete" else d[0, 0] if d.size == 1 else n @ d @ o / w[i]
            yield pd.DataFrame({"a": f["a"], "b": f["b"], "m": m, "w": w})

    parts = dealt.join(side("a"), "a").join(side("b"), "b").mapInPandas(measured, "a long, b long, m double, w double")
    m = F.max("m") if linkage == "complete" else F.when(F.count("*") == 1, F.max("m")).otherwise(
        F.sum(F.col("m") * F.col("w")) / F.sum("w"))
    return parts.groupBy("a", "b").agg(m.alias("m"))


def _joined(clusters: DataFrame, merges: DataFrame) -> DataFrame:
    """``clusters`` after merges."""
    side = lambda s: clusters.select(*[F.col(c).alias(f"{c}{s}") for c in clusters.columns])
    both = merges.join(side("a"), F.col("a") == F.col("ida")).join(side("b"), F.col("b") == F.col("idb"))
    total, pairs = F.col("na") + F.col("nb"), F.col("na") * F.col("nb")
    both = both.withColumn("gap", F.aggregate(F.zip_with("za", "zb", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    new = both.select(
        F.col("a").alias("id"), total.alias("n"),
        F.zip_with("za", "zb", lambda u, v: (F.col("na") * u + F.col("nb") * v) / total).alias("z"),
        ((F.col("na") * F.col("wa") + F.col("nb") * F.col("wb")) / total + pairs / (total * total) * F.col("gap")).alias("w"),
        F.greatest(F.col("ra") + F.sqrt("gap") * F.col("nb") / total, F.col("rb") + F.sqrt("gap") * F.col("na") / total).alias("r"))
    ends = merges.select(F.explode(F.array("a", "b")).alias("id"))
    return clusters.join(ends, "id", "left_anti").unionByName(new)


def _union(one: DataFrame | None, other: DataFrame) -> DataFrame:
    return other if one is None else one.unionByName(other)


def _folded(table: DataFrame, merges: DataFrame, linkage: str) -> DataFrame:
    """The table after merges: names, sizes and variances of merged clusters are
    new, and their rows with another cluster become one."""
    for side in ("a", "b"):
        new = merges.select(F.explode(F.array("a", "b")).alias("old"), F.col("a").alias("new"), F.col("n").alias("nn"), F.col("w").alias("nw"))
        new = new.withColumnsRenamed({c: f"{c}_{side}" for c in new.columns})
        table = table.join(new, F.col(side) == F.col(f"old_{side}"), "left")
    part = {s: F.struct(F.coalesce(f"new_{s}", s).alias("id"), F.coalesce(f"nn_{s}", f"n{s}").alias("n"),
                        F.coalesce(f"nw_{s}", f"w{s}").alias("w")) for s in ("a", "b")}
    ends = F.array_sort(F.array(part["a"], part["b"]))
    rows = table.select(ends.alias("e"), "m", (F.col("na") * F.col("nb")).alias("pairs")).where(F.col("e")[0]["id"] != F.col("e")[1]["id"])
    m = F.max("m") if linkage == "complete" else F.sum(F.col("m") * F.col("pairs")) / F.sum("pairs")
    return rows.groupBy("e").agg(m.alias("m")).select(
        *[F.col("e")[i][c].alias(n) for i, s in ((0, "a"), (1, "b")) for c, n in (("id", s), ("n", f"n{s}"), ("w", f"w{s}"))], "m").select(
        "a", "b", "m", "na", "nb", "wa", "wb")


def _finish(rows: pd.DataFrame, linkage: str, step: int) -> pd.DataFrame:
    """All merges of at most ``LAST`` clusters, cheapest first."""
    ids = np.unique(np.concatenate([rows["a"], rows["b"]]))
    i, j = np.searchsorted(ids, rows["a"]), np.searchsorted(ids, rows["b"])
    k = len(ids)
    m, n, w = np.full((k, k), np.inf), np.ones(k), np.zeros(k)
    m[i, j] = m[j, i] = rows["m"]
    n[i], n[j], w[i], w[j] = rows["na"], rows["nb"], rows["wa"], rows["wb"]
    alive, out = np.ones(k, bool), []
    for s in range(k - 1):
        v = _linkage(linkage, m, n[:, None], n[None, :], w[:, None], w[None, :])
        v = np.where(alive[:, None] & alive[None, :] & ~np.eye(k, dtype=bool), v, np.inf)
        a, b = sorted(np.unravel_index(np.argmin(v), v.shape))
        out.append((ids[a], ids[b], float(v[a, b]), step + s))
        joint = np.maximum(m[a], m[b]) if linkage == "complete" else (n[a] * m[a] + n[b] * m[b]) / (n[a] + n[b])
        w[a] = (n[a] * w[a] + n[b] * w[b] + v[a, b]) / (n[a] + n[b])
        m[a], m[:, a], m[a, a] = joint, joint, np.inf
        n[a], alive[b] = n[a] + n[b], False
    return pd.DataFrame(out, columns=["a", "b", "height", "step"])


def _points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows with numbers in their order, ``n`` rows each."""
    plain = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    names = plain.columns
    known = plain.where(~F.exists(F.array(*names), lambda v: v.isNull() | F.isnan(v)))
    return with_ordinal(known.groupBy(*names).agg(F.count("*").alias("n")), names, "id").withColumn("x", F.array(*names))


def merges(points: DataFrame, affinity: str, linkage: str) -> DataFrame:
    """Merges (a, b, height, step) of a hierarchy of ``points`` (id, x, n)."""
    if linkage in ("average", "complete") and affinity == "euclidean" and points.count() > LAST and (unit := _unit(points)):
        return merge_near(points, unit, linkage)
    if linkage != "single":
        return merge_rounds(points, pair_table(points, affinity), linkage)
    if affinity == "cosine":  # of unit rows this distance is half the square of the euclidean one
        norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
        points = points.withColumn("x", F.transform("x", lambda v: v / F.when(norm > 0, norm).otherwise(1.0)))
    tree = spanning_tree(points)
    if tree is None:
        return points.sparkSession.createDataFrame([], _MERGES)
    height = F.col("height") * F.col("height") / 2 if affinity == "cosine" else F.col("height")
    return tree.select("a", "b", height.alias("height"), F.lit(0).cast("long").alias("step"))


def agglomerative(df: DataFrame, cols: Sequence[str], k: int, *, affinity: str = "euclidean", linkage: str = "complete",
                  key: Sequence[str] = (), label: str = "cluster") -> DataFrame:
    """``df`` with ``label``, 0 to k - 1 in the order of the clusters' least rows
    (by ``cols``): the hierarchy cut at ``k`` clusters, or as many as there are
    distinct rows.  A row with a missing or NaN value has no cluster.  ``key`` is
    not used."""
    if linkage not in LINKAGES or affinity not in ("euclidean", "cosine"):
        raise ValueError(f"unknown linkage {linkage!r} or affinity {affinity!r}")
    if not 1 <= k <= MAX_CLUSTERS:
        raise ValueError(f"between 1 and {MAX_CLUSTERS} clusters")
    cols = list(cols)
    points = _written(_points(df, cols))
    tree = _written(merges(points.select("id", "x", "n"), affinity, linkage))
    # without the k - 1 highest merges; of equal heights the later one goes first
    order = ["height", "step", "a", "b"]
    top = tree.orderBy(*[F.desc(c) for c in order]).limit(k - 1).select("a", "b", F.lit(True).alias("cut"))
    kept = tree.join(top, ["a", "b"], "left_anti")
    roots = components(points.select("id"), kept)
    numbers = {r["root"]: i for i, r in enumerate(sorted(bounded_rows(roots.select("root").distinct(), k, "clusters")))}
    named = _numbered(df.sparkSession, numbers, label)
    labelled = points.join(roots, "id").join(F.broadcast(named), "root").select(
        *[F.col(f"_{i}") for i in range(len(cols))], F.col(label).alias("_label"))
    same: Column = F.lit(True)
    for i, c in enumerate(cols):
        same = same & (df[c].cast("double") == F.col(f"_{i}"))
    return df.join(labelled, same, "left").select(*[df[c] for c in df.columns], F.col("_label").alias(label))


def _numbered(spark: SparkSession, numbers: dict, label: str) -> DataFrame:
    return spark.createDataFrame([(r, i) for r, i in numbers.items()], f"root long, {label} int")
