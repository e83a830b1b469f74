"""Exact k nearest neighbours and voting (K1-K4).

Training rows lie in the cells of a two-level tree of pivots, whose number
grows with the rows.  For a test row, counts and radii of the upper cells bound
its k-th distance, and by the triangle inequality whole branches fall away; the
lower cells of those left sharpen the bound and only cells that can hold a
closer row are visited: exact for every Minkowski r >= 1.  Cells that lie
together are a shard; a test row is sent, with its bound, to the shards that it
visits.  Where a sample of test rows visits most cells (many dimensions), all
rows of a group are one shard and no bounds are worked out.

A shard of many rows is dealt into blocks by hash, as are its test rows; blocks
grow with the rows up to ``BLOCK_BYTES``.  A task sees one pair of blocks tile by
tile: a lower bound of every distance (a matrix product, for order 1 sums of
small integers) picks the pairs whose distance is worked out, and at most k rows
of each test row come back.  Equal training rows are first thinned to those that
can be neighbours.  Distances of several orders share the tree and the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.scale import bounded_rows, cut_lineage

BLOCK_ROWS = 4096
#: Bounds of a block's vectors and of the pairs of a tile, rows of a tile, dimensions up to which distances are worked out at once.
BLOCK_BYTES, TILE_PAIRS, TILE_ROWS, FEW_DIMENSIONS = 32 << 20, 1 << 21, 1024, 6
#: Share of the rows that test rows may visit before all of them are compared.
DENSE_SHARE, SAMPLE = 0.5, 256
#: Rows of a lower cell, and bounds of what is broadcast: pivots, bytes of them, cells of all groups.
ROWS_PER_PIVOT = 256
MAX_PIVOTS, PIVOT_BYTES, MAX_SLOTS = 1 << 16, 32 << 20, 1 << 19
MAX_GROUPS = 100_000
#: Where the lower bound of order 3 touches, as a share of the mean square of a difference at the limit.
CUBE_TOUCH = 1.0
DIGITS = 9  # distances are compared after rounding, so ties do not depend on summation order


def feature_array(cols: Sequence[str] | str) -> Column:
    if isinstance(cols, str):
        return F.col(cols).cast("array<double>")
    return F.array(*[F.col(c).cast("double") for c in cols])


def _distances(a: np.ndarray, b: np.ndarray, r: int, pairs: bool = False) -> np.ndarray:
    """|a_i - b_j| for all i, j, in slices of bounded memory; with ``pairs`` only
    |a_i - b_i|."""
    out = np.empty(len(a) if pairs else (len(a), len(b)))
    step = max(1, len(a) if pairs else 250_000 // max(1, b.size))
    for s in range(0, len(a), step):
        diff = a - b if pairs else a[s:s + step, None, :] - b[None, :, :]
        if r == 2:
            out[s:s + step] = np.sqrt((diff * diff).sum(-1))
            continue
        np.abs(diff, out=diff)
        power = diff.copy() if r > 1 else diff
        for _ in range(r - 1):
            power *= diff
        out[s:s + step] = power.sum(-1) ** (1.0 / r) if r > 1 else power.sum(-1)
    return out


class _Tree:
    """Pivots in two levels: ``lower`` pivots, sorted by the one of ``upper``
    that each is nearest to; ``first`` has where the branches start."""

    def __init__(self, points: np.ndarray, rs: Sequence[int]):
        n = max(1, int(np.ceil(np.sqrt(len(points)))))
        self.rs, self.upper = tuple(rs), points[:n]
        parent = _distances(points, self.upper, self.rs[0]).argmin(1)
        place = np.empty(len(points), np.int64)
        place[_together(points)] = np.arange(len(points))
        order = np.lexsort((place, parent))
        self.lower, self.parent = points[order], parent[order]
        self.first = np.searchsorted(self.parent, np.arange(n + 1))

    def place(self, x: np.ndarray) -> np.ndarray:
        """Lower cell of each row: the nearest pivot within the nearest branch."""
        branch = _distances(x, self.upper, self.rs[0]).argmin(1)
        cell = np.empty(len(x), np.int64)
        for t in np.unique(branch).tolist():
            rows = np.flatnonzero(branch == t)
            cell[rows] = self.first[t] + _distances(x[rows], self.lower[self.first[t]:self.first[t + 1]], self.rs[0]).argmin(1)
        return cell

    def gaps(self, x: np.ndarray, cell: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the pivots of both levels."""
        far = lambda p: _paired(x, p, r)
        return far(self.lower[cell]), far(self.upper[self.parent[cell]])


def _together(points: np.ndarray) -> np.ndarray:
    """An order in which near points follow each other: halves along the widest
    coordinate."""
    todo, out = [np.arange(len(points))], []
    while todo:
        some = todo.pop()
        if len(some) <= 4:
            out.append(some)
            continue
        at = points[some]
        some = some[np.argsort(at[:, np.ptp(at, axis=0).argmax()], kind="stable")]
        todo += [some[len(some) // 2:], some[:len(some) // 2]]
    return np.concatenate(out)


def _paired(a: np.ndarray, b: np.ndarray, r: int) -> np.ndarray:
    return (np.abs(a - b) ** r).sum(-1) ** (1.0 / r)


class _Cells:
    """Rows and radii of the cells of every group; ``rows`` are already net of
    the largest set that a test row might have to skip."""

    def __init__(self, tree: _Tree, groups: int, k: int, stats: list):
        self.tree, self.k, m, n = tree, k, len(tree.lower), len(tree.upper)
        self.rows, self.all = np.zeros((groups, m)), np.zeros((groups, m), np.int64)
        self.radius = np.full((len(tree.rs), groups, m), -np.inf)
        self.upper_radius = np.full((len(tree.rs), groups, n), -np.inf)
        for s in stats:
            g, c = s["_g"], s["_cell"]
            self.rows[g, c], self.all[g, c] = s["n"] - s["lost"], s["n"]
            for i in range(len(tree.rs)):
                self.radius[i, g, c] = s[f"low{i}"]
                t = tree.parent[c]
                self.upper_radius[i, g, t] = max(self.upper_radius[i, g, t], s[f"up{i}"])
        self.upper_rows = np.add.reduceat(self.rows, tree.first[:-1], axis=1) if m else self.rows
        self.upper_rows[:, np.diff(tree.first) == 0] = 0

    def visits(self, x: np.ndarray, g: np.ndarray) -> Iterator[tuple[np.ndarray, list, np.ndarray]]:
        """Some rows at a time: their numbers, for each order the rows and cells
        that must meet, and the bounds of the k-th distances by order."""
        near = _distances(x, self.tree.upper, self.tree.rs[0]).argmin(1)
        order = np.lexsort((near, g))  # rows of one place open few branches
        step = max(1, 2_000_000 // len(self.tree.lower))
        for s in range(0, len(x), step):
            some = order[s:s + step]
            found = [self._visits(x[some], g[some], i) for i in range(len(self.tree.rs))]
            yield some, [(row, cell) for row, cell, _ in found], np.stack([bound for _, _, bound in found], 1)

    def _visits(self, x: np.ndarray, g: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tree, r = self.tree, self.tree.rs[i]
        gap, radius = _distances(x, tree.upper, r), self.upper_radius[i][g]
        far = gap + radius
        order = np.argsort(far, axis=1)
        held = np.cumsum(np.take_along_axis(self.upper_rows[g], order, 1), axis=1)
        enough = held >= self.k
        first = enough.argmax(axis=1)
        bound = np.where(enough.any(axis=1), np.take_along_axis(far, order, 1)[np.arange(len(x)), first], np.inf)
        open_ = (gap - radius <= bound[:, None] + 1e-6) & (radius > -np.inf)
        rows, cells, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for t in np.flatnonzero(open_.any(axis=0)).tolist():
            some = np.flatnonzero(open_[:, t])
            lower = np.arange(tree.first[t], tree.first[t + 1])
            gaps.append(_distances(x[some], tree.lower[lower], r).ravel())
            rows.append(np.repeat(some, len(lower)))
            cells.append(np.tile(lower, len(some)))
        row, cell, gap = np.concatenate(rows), np.concatenate(cells), np.concatenate(gaps)
        there = self.all[g[row], cell] > 0
        row, cell, gap = row[there], cell[there], gap[there]
        radius = self.radius[i][g[row], cell]
        order = np.lexsort((gap + radius, row))
        far = (gap + radius)[order]
        held = np.cumsum(self.rows[g[row], cell][order])
        start = np.searchsorted(row[order], np.arange(len(x) + 1))
        base = np.concatenate([[0.0], held])[start[:-1]]
        reached = held - base[row[order]] >= self.k
        # of each row the first place where enough rows are held
        place = np.flatnonzero(reached)
        owner, at = np.unique(row[order][place], return_index=True)
        bound[owner] = np.minimum(bound[owner], far[place[at]])
        keep = gap - radius <= bound[row] + 1e-6
        return row[keep], cell[keep], bound + 1e-6


def _sample(base: DataFrame, rows: int, wanted: int) -> np.ndarray:
    """About ``wanted`` different points, by hash of the key; all if there are no more."""
    share = min(1.0, (1.2 * wanted + 16) / max(1, rows))
    some = base.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else base
    got = some.select(F.xxhash64("_id").alias("h"), "_x").limit(2 * wanted + 64).collect() or \
        base.select(F.lit(0).alias("h"), "_x").limit(1).collect()
    points = np.array([r["_x"] for r in sorted(got, key=lambda r: (r["h"], r["_x"]))], float)
    if not len(points):
        return points
    _, first = np.unique(points, axis=0, return_index=True)
    return points[np.sort(first)][:wanted]


def _thinned(base: DataFrame, k: int, alone: bool) -> DataFrame:
    """Of equal rows those that can be among the k nearest: the first k of each
    set that a test row may skip, or k + 1 where such sets are single rows."""
    same = ["_g", "_x"] if alone else ["_g", "_x", "_skip"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("_id"))
    return base.withColumn("_place", place).where(F.col("_place") <= k + alone).drop("_place")


def knn(train: DataFrame, test: DataFrame, k: int, r: int | Sequence[int] = 2, *, key: str = "row_id",
        features: Sequence[str] | str = "features", label: str = "label", by: Sequence[str] = (),
        exclude: str | None = None, pivots: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(by..., test_id, rank, train_id, distance, label): ranks 1..k by
    (distance, training key).

    ``r``: order of the distance; several orders give a column ``r`` too, and
    share all passes over the rows.
    ``pivots`` and ``block_rows``: at least so many cells (more where the rows
    need them), and rows of a block that is not split for more tasks.
    ``by``: neighbours only within equal values of these columns, of which there
    are at most ``MAX_GROUPS``.
    ``exclude``: rows sharing this value are never neighbours (the row itself
    for leave-one-out, the fold for cross-validation).
    A training row with a missing or NaN feature is no neighbour.  A test row of
    that kind, or one without any neighbour, has one row of rank 1 whose
    ``train_id``, ``distance`` and ``label`` are null if it is of that kind, and
    none otherwise."""
    by, rs = list(by), [r] if isinstance(r, int) else list(r)
    skip = F.col(exclude).cast("string") if exclude else F.lit(None).cast("string")
    keys = [F.col(c).alias(c) for c in by]  # fresh columns: both sides may come from one frame
    base = train.select(*keys, F.col(key).alias("_id"), feature_array(features).alias("_x"),
                        F.col(label).alias("_y"), skip.alias("_skip"))
    probe = test.select(*keys, F.col(key).alias("_id"), feature_array(features).alias("_x"), skip.alias("_skip"))
    whole = ~F.exists("_x", lambda v: v.isNull() | F.isnan(v))
    base = base.where(F.coalesce(whole, F.lit(False)))
    groups = 1
    if by:
        listed = bounded_rows(base.select(*by).distinct(), MAX_GROUPS, "groups of neighbours")
        groups = max(1, len(listed))
        numbers = base.sparkSession.createDataFrame(
            [(*row, i) for i, row in enumerate(listed)],
            ", ".join([*[f"_by{j} {dict(base.dtypes)[c]}" for j, c in enumerate(by)], "_g int"]))

        def numbered(df):
            same = [F.col(c).eqNullSafe(F.col(f"_by{j}")) for j, c in enumerate(by)]
            return df.join(F.broadcast(numbers), same, "left").drop(*[f"_by{j}" for j in range(len(by))])
    else:
        def numbered(df):
            return df.withColumn("_g", F.lit(0))
    types = dict(base.dtypes)
    base = cut_lineage(_thinned(numbered(base).drop(*by), k, exclude is None or exclude == key))
    probe = numbered(probe).withColumn("_ok", F.coalesce(whole, F.lit(False)))
    sizes = np.zeros(groups, np.int64)
    for s in base.groupBy("_g").agg(F.count("*").alias("n")).collect():  # a row for each group
        sizes[s["_g"]] = s["n"]
    dims = max(1, (base.select(F.max(F.size("_x"))).first()[0] or 1))
    out_cols = [f"`{c}` {types[c]}" for c in by] + [
        f"test_id {dict(probe.dtypes)['_id']}", f"train_id {types['_id']}", "distance double", f"label {types['_y']}", "_r int"]
    lost = probe.where(~F.col("_ok")).select(
        *by, F.col("_id").alias("test_id"), F.lit(None).cast(types["_id"]).alias("train_id"),
        F.lit(None).cast("double").alias("distance"), F.lit(None).cast(types["_y"]).alias("label"),
        F.explode(F.lit(rs)).alias("_r"))
    if sizes.any():
        whole_probe = probe.where("_ok and _g is not null").drop("_ok")
        cells = None
        if pivots is not None or sizes.max() > 2 * block_rows:
            wanted = max(pivots or 1, -(-int(sizes.sum()) // ROWS_PER_PIVOT))
            wanted = max(1, min(wanted, MAX_PIVOTS, PIVOT_BYTES // (8 * dims), MAX_SLOTS // groups))
            cells = _cells(base, _sample(base, int(sizes.sum()), wanted), groups, k, rs, exclude is not None)
        lost = _search(base, whole_probe, cells, sizes, dims, k, rs, by, exclude is not None, block_rows, out_cols).unionByName(lost)
    ranked = rank_neighbours(lost, k, [*by, "_r"])
    return ranked.drop("_r") if isinstance(r, int) else ranked.withColumnRenamed("_r", "r")


def _cells(base: DataFrame, points: np.ndarray, groups: int, k: int, rs: list[int], skips: bool) -> _Cells:
    """The tree over ``points`` with counts and radii of its cells."""
    tree = _Tree(points, rs)  # travels with the function: a broadcast would name a module that executors need not have
    gaps = ", ".join(f"_low{i} double, _up{i} double" for i in range(len(rs)))

    def place(frames):
        for f in frames:
            if len(f):
                x = np.stack(f["_x"].to_numpy())
                f["_cell"] = tree.place(x)
                for i, r in enumerate(rs):
                    f[f"_low{i}"], f[f"_up{i}"] = tree.gaps(x, f["_cell"].to_numpy(), r)
                yield f.drop(columns=["_x"])

    placed = base.select("_g", "_skip", "_x").mapInPandas(place, f"_g int, _skip string, _cell long, {gaps}")
    tops = [F.max(f"_{c}{i}").alias(f"{c}{i}") for i in range(len(rs)) for c in ("low", "up")]
    again = [F.max(f"{c}{i}").alias(f"{c}{i}") for i in range(len(rs)) for c in ("low", "up")]
    if skips:  # the largest set that a test row may have to skip
        stats = placed.groupBy("_g", "_cell", "_skip").agg(F.count("*").alias("n"), *tops).groupBy("_g", "_cell").agg(
            F.max("n").alias("lost"), F.sum("n").alias("n"), *again)
    else:
        stats = placed.groupBy("_g", "_cell").agg(F.count("*").alias("n"), F.lit(0).alias("lost"), *tops)
    return _Cells(tree, groups, k, stats.collect())  # at most MAX_SLOTS rows


def _share(cells: _Cells, probe: DataFrame, sizes: np.ndarray) -> float:
    """Share of the rows of its group that a test row visits, of some by hash."""
    some = probe.select("_g", "_x", F.xxhash64("_id").alias("h")).orderBy("h").limit(SAMPLE).collect()
    if not some:
        return 1.0
    g, visited = np.array([s["_g"] for s in some]), 0.0
    for rows, found, _ in cells.visits(np.array([s["_x"] for s in some], float), g):
        visited += max(float((cells.all[g[rows][row], cell] / sizes[g[rows][row]]).sum()) for row, cell in found)
    return visited / len(some)


def _blocks(rows: int, tests: int, least: int, most: int, tasks: float) -> tuple[int, int]:
    """Blocks of both sides: no block above ``most`` rows, and as many pairs as
    ``tasks`` where blocks keep ``least`` rows."""
    a, b = max(1, -(-rows // most)), max(1, -(-tests // most))
    while a * b < tasks and max(rows / a, tests / b) > least:
        if rows / a > tests / b:
            a += 1
        else:
            b += 1
    return a, b


class _Shards:
    """Runs of cells of a group that lie together, of about ``rows`` rows;
    without cells each group is one shard."""

    def __init__(self, sizes: np.ndarray, cells: _Cells | None, rows: float):
        self.cells = cells
        if cells is None:
            self.of, self.rows = np.arange(len(sizes))[:, None], sizes
            return
        self.of, start = np.zeros(cells.all.shape, np.int64), 0
        for g, held in enumerate(cells.all):
            run = np.maximum(np.cumsum(held) - held, 0) // max(1, int(rows))
            _, run = np.unique(run, return_inverse=True)
            self.of[g] = start + run
            start += int(run.max()) + 1
        self.rows = np.bincount(self.of.ravel(), cells.all.ravel(), start).astype(np.int64)

    def place(self, x: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and shard of each row."""
        cell = np.zeros(len(x), np.int64) if self.cells is None else self.cells.tree.place(x)
        return cell, self.of[g, cell]


def _search(base: DataFrame, probe: DataFrame, cells: _Cells | None, sizes: np.ndarray, dims: int, k: int, rs: list[int],
            by: list[str], skips: bool, block_rows: int, out_cols: list[str]) -> DataFrame:
    """At most k candidates of each test row from every pair of blocks it meets."""
    context = base.sparkSession.sparkContext
    tasks, most = 4 * context.defaultParallelism, max(1024, BLOCK_BYTES // (8 * dims + 64))
    share = 1.0 if cells is None else _share(cells, probe, sizes)
    dense = share > DENSE_SHARE
    if dense:
        cells = None
    total = int(sizes.sum())
    size = min(most, max(block_rows, share * total / 8, min(BLOCK_ROWS, total / tasks)))
    shards = _Shards(sizes, cells, size)
    types = dict(probe.dtypes)
    shape = ", ".join(f"`{c}` {types[c]}" for c in probe.columns)
    met = np.zeros(len(shards.rows), np.int64)
    if dense:
        counts = probe.groupBy(F.col("_g").cast("long").alias("s")).agg(F.count("*").alias("n"))
    else:
        def visit(frames):
            for f in frames:
                if len(f):
                    g = f["_g"].to_numpy()
                    for some, found, bounds in shards.cells.visits(np.stack(f["_x"].to_numpy()), g):
                        row = np.concatenate([row for row, _ in found])
                        shard = np.concatenate([shards.of[g[some][row], cell] for row, cell in found])
                        pairs = np.unique(row * len(shards.rows) + shard)
                        row, shard = pairs // len(shards.rows), pairs % len(shards.rows)
                        out = f.iloc[some].copy()
                        out["_bounds"] = list(bounds)
                        out["_shards"] = np.split(shard, np.searchsorted(row, np.arange(1, len(some))))
                        yield out

        shape += ", _bounds array<double>, _shards array<long>"
        probe = cut_lineage(probe.mapInPandas(visit, shape))
        counts = probe.select(F.explode("_shards").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    for v in counts.collect():  # a row for each shard, at most MAX_SLOTS
        met[v["s"]] = v["n"]
    work = shards.rows.astype(float) * met
    blocks = np.array([_blocks(int(n), int(t), block_rows if dense else int(size), most, tasks * w / max(1.0, work.sum()))
                       for n, t, w in zip(shards.rows, met, work)], np.int64).T
    sent = context.broadcast(blocks)

    def deal(f: pd.DataFrame, shard: np.ndarray, own: int) -> pd.DataFrame:
        """The row's own block by hash, and one copy for each block of the other side."""
        mine, other = sent.value[own][shard], sent.value[1 - own][shard]
        row = np.repeat(np.arange(len(f)), other)
        copy = np.arange(len(row)) - np.repeat(np.cumsum(other) - other, other)
        block = (f["_h"].to_numpy() % mine)[row]
        out = f.iloc[row].drop(columns=["_h"])
        out["_shard"] = shard[row]
        out["_b"], out["_t"] = (block, copy) if own == 0 else (copy, block)
        return out

    def deal_tests(frames):
        for f in frames:
            for s in range(0, len(f), 1000):
                some = f.iloc[s:s + 1000]
                if dense:
                    yield deal(some, some["_g"].to_numpy().astype(np.int64), 1)
                else:
                    shard = some["_shards"].to_numpy()
                    row = np.repeat(np.arange(len(some)), [len(v) for v in shard])
                    yield deal(some.iloc[row].drop(columns=["_shards"]), np.concatenate([np.zeros(0, np.int64), *shard]), 1)

    def deal_training(frames):
        for f in frames:
            for s in range(0, len(f), 1000):
                some = f.iloc[s:s + 1000].copy()
                some["_cell"], shard = shards.place(np.stack(some["_x"].to_numpy()), some["_g"].to_numpy())
                yield deal(some, shard, 0)

    hashed = F.shiftrightunsigned(F.xxhash64("_id"), 1).alias("_h")
    base_types, where = dict(base.dtypes), "_shard long, _b long, _t long"
    left = probe.select("*", hashed).mapInPandas(deal_tests, f"{shape.replace(', _shards array<long>', '')}, {where}")
    right = base.select("_g", "_id", "_x", "_y", "_skip", hashed).mapInPandas(
        deal_training, f"_g int, _id {base_types['_id']}, _x array<double>, _y {base_types['_y']}, _skip string, _cell long, {where}")
    group = ["_shard", "_t", "_b"]
    names = [c.split()[0].strip("`") for c in out_cols]

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame(columns=names)
        b = b.sort_values("_id")
        codes = pd.factorize(pd.concat([a["_skip"], b["_skip"]]), use_na_sentinel=False)[0] if skips else None
        x, y, parts = np.stack(a["_x"].to_numpy()), np.stack(b["_x"].to_numpy()), []
        for i, r in enumerate(rs):
            best = _Best(x, y, codes, k, r)
            if dense:
                best.all()
            else:
                best.bound(np.array([v[i] for v in a["_bounds"]], float))
                best.cells(shards.cells, i, int(a["_g"].iat[0]), b["_cell"].to_numpy())
            at, which, dist = best.found()
            out = pd.DataFrame({c: a[c].to_numpy()[at] for c in by})
            out["test_id"], out["train_id"] = a["_id"].to_numpy()[at], b["_id"].to_numpy()[which]
            out["distance"], out["label"], out["_r"] = dist, b["_y"].to_numpy()[which], r
            parts.append(out)
        return pd.concat(parts)

    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(nearest, ", ".join(out_cols))


class _Best:
    """The k nearest columns of every row, (distance, column) ascending, held
    over tiles.  ``codes``: rows and columns of equal code never meet."""

    def __init__(self, x: np.ndarray, y: np.ndarray, codes: np.ndarray | None, k: int, r: int):
        self.x, self.y, self.k, self.r = x, y, k, r
        self.mine, self.theirs = (None, None) if codes is None else (codes[:len(x)], codes[len(x):])
        self.dist, self.column = np.full((len(x), k), np.inf), np.full((len(x), k), len(y))
        self.limit = np.full(len(x), np.inf)
        # by code, so that pairs to be skipped are a few rectangles of a tile
        self.rows = np.arange(len(x)) if codes is None else np.argsort(self.mine, kind="stable")
        self.columns = np.arange(len(y)) if codes is None else np.argsort(self.theirs, kind="stable")
        self._prepare()

    def _prepare(self) -> None:
        """What the lower bounds need; vectors of few or huge values have none."""
        d, r = self.x.shape[1], self.r
        ends = [f(v) for v in (self.x, self.y) for f in (np.min, np.max)] if d else [0.0]
        self.kind = "whole"
        if d <= FEW_DIMENSIONS or not max(map(abs, ends)) < 1e100:
            return
        middle = self.y.mean(0)
        a, b = self.x - middle, self.y - middle
        if r == 1:
            levels = 32_000 // d
            low, high = np.quantile(b[::max(1, len(b) // 4096)], [0.001, 0.999])
            if levels >= 16 and high > low:
                # cut off at the ends no difference grows, and each is off by less than one level
                self.unit, self.kind = (high - low) / levels, "levels"
                small = lambda v: np.floor((np.clip(v, low, high) - low) / self.unit).clip(0, levels).astype(np.int16)
                self.a, self.b = small(a), np.ascontiguousarray(small(b).T)
            return
        # squared euclidean distance as one product; of order r it is at most d ** (1 - 2 / r) times the square of the distance
        self.near, self.far = a, b
        self.na, self.nb = (a * a).sum(-1), (b * b).sum(-1)
        self.wide = 1e-14 * (d + 8) * ((self.x ** 2).sum(-1).max() + (self.y ** 2).sum(-1).max())
        self.kind, self.factor = "product", float(d) ** (1 - 2 / r)
        self._product(np.float32 if max(map(abs, ends)) < 1e8 else np.float64)
        self.cubes = None
        if r == 3 and self.a.dtype == np.float32:
            self.fours = (a ** 4).sum(-1), (b ** 4).sum(-1)
            self.cubes = np.ascontiguousarray(np.column_stack(
                [b, b ** 2, b ** 3, self.nb, self.fours[1], np.ones(len(b))]).T.astype(np.float32))

    def _product(self, kind: type) -> None:
        """Both sides of the product, and how far off its sums can be."""
        d = self.x.shape[1]
        self.a = np.column_stack([-2 * self.near, self.na, np.ones(len(self.na))]).astype(kind)
        self.b = np.ascontiguousarray(np.column_stack([self.far, np.ones(len(self.nb)), self.nb]).T.astype(kind))
        self.slack = self.wide + 4 * np.finfo(kind).eps * (d + 8) * (self.na.max() + self.nb.max())

    def _cubes(self, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """For order 3 a sum of polynomials in the squares u of the differences
        that is at most the sum of their ``u ** 1.5`` where no u passes the
        square of the limit (else the distance does), and what it is at most.
        None where single precision is too coarse for the limits."""
        d, limit = self.x.shape[1], self.limit[rows] + 1e-8
        known = np.isfinite(limit)
        top = np.where(known, limit, 1.0) ** 2
        v = CUBE_TOUCH * top / d ** (2 / 3)  # touched at v, met at the square of the limit, below between
        c2 = (top ** 1.5 - v ** 1.5 - 1.5 * v ** 0.5 * (top - v)) / (top - v) ** 2
        c1, c0 = 1.5 * v ** 0.5 - 2 * c2 * v, c2 * v * v - 0.5 * v ** 1.5
        na, fours = self.na[rows], self.fours[0][rows]
        slack = 4 * np.finfo(np.float32).eps * (3 * d + 8) * (
            d * np.abs(c0) + 2 * np.abs(c1) * (na + self.nb.max()) + 8 * c2 * (fours + self.fours[1].max())) + 3 * np.sqrt(top) * self.wide
        if np.median(slack / top ** 1.5) > 0.05:
            return None
        x, one, two = self.near[rows], c1[:, None], c2[:, None]
        a = np.column_stack([-2 * one * x - 4 * two * x ** 3, 6 * two * x ** 2, -4 * two * x, c1, c2, d * c0 + c1 * na + c2 * fours])
        a[~known] = 0
        most = np.where(known, top ** 1.5 * (1 + 1e-6) + slack, 1.0)
        return a.astype(np.float32) @ np.take(self.cubes, columns, axis=1), most

    def _low(self, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, float]:
        """A number for each pair that is small where the distance can be, and
        the number of pairs that never meet."""
        if self.kind == "whole":
            low = np.round(_distances(self.x[rows], self.y[columns], self.r), DIGITS)
            low[np.isnan(low)] = np.inf
            return low, np.inf
        if self.kind == "product":
            return self.a[rows] @ np.take(self.b, columns, axis=1), np.inf
        low, b = np.zeros((len(rows), len(columns)), np.int16), np.take(self.b, columns, axis=1)
        part = np.empty((32, len(columns)), np.int16)
        for s in range(0, len(rows), 32):
            a, out = self.a[rows[s:s + 32]], low[s:s + 32]
            diff = part[:len(a)]
            for j in range(a.shape[1]):
                np.subtract(a[:, j, None], b[j], out=diff)
                np.abs(diff, out=diff)
                np.add(out, diff, out=out)
        return low, 32_767

    def _most(self, limit: np.ndarray) -> np.ndarray:
        """What ``_low`` is at most for distances up to ``limit``."""
        if self.kind == "levels":
            return np.minimum((limit + 1e-8) * (1 + 1e-12) / self.unit + self.x.shape[1] + 1, 32_766).astype(np.int16)
        if self.kind == "product":
            with np.errstate(over="ignore"):
                limit = self.factor * (limit + 1e-8) ** 2 * (1 + 1e-12) + self.slack
                if self.a.dtype == np.float32:
                    return np.nextafter(np.minimum(limit, 1e38).astype(np.float32), np.float32(np.inf))
        return np.minimum(limit, np.finfo(float).max)

    def bound(self, limit: np.ndarray) -> None:
        """Distances that the k-th neighbour over all blocks does not pass."""
        self.limit = np.minimum(self.limit, limit)

    def all(self) -> None:
        step = max(1, TILE_PAIRS // TILE_ROWS)
        for s in range(0, len(self.rows), TILE_ROWS):
            for t in range(0, len(self.columns), step):
                self.tile(self.rows[s:s + TILE_ROWS], self.columns[t:t + step])

    def cells(self, cells: _Cells, i: int, g: int, cell: np.ndarray) -> None:
        """Only pairs of a row and a cell that can hold a closer one: first each
        row's nearest cell, then the others."""
        here = np.unique(cell)
        gap = _distances(self.x, cells.tree.lower[here], self.r)
        first, low = gap.argmin(1), gap - cells.radius[i, g, here] - 1e-6
        inside = [self.columns[cell[self.columns] == c] for c in here]
        for again in (False, True):
            for c, columns in enumerate(inside):
                rows = self.rows[((first == c) != again)[self.rows]]
                rows = rows[low[rows, c] <= self.limit[rows]]
                step = max(1, TILE_PAIRS // max(1, len(columns)))
                for s in range(0, len(rows), step):
                    for t in range(0, len(columns), TILE_PAIRS):
                        self.tile(rows[s:s + step], columns[t:t + TILE_PAIRS])

    def _skip(self, rows: np.ndarray, columns: np.ndarray, low: np.ndarray, never: float) -> None:
        """Takes the pairs that never meet out of a tile."""
        if self.mine is None:
            return
        codes, starts = np.unique(self.mine[rows], return_index=True)
        theirs = self.theirs[columns]
        lo, hi = np.searchsorted(theirs, codes), np.searchsorted(theirs, codes, "right")
        ends = np.append(starts[1:], len(rows))
        for c in np.flatnonzero(hi > lo).tolist():
            low[starts[c]:ends[c], lo[c]:hi[c]] = never

    def tile(self, rows: np.ndarray, columns: np.ndarray) -> None:
        new = np.flatnonzero(self.limit[rows] == np.inf) if len(columns) > self.k else np.zeros(0, np.int64)
        cubes = None
        if self.kind != "product" or self.cubes is None or len(new) or not (cubes := self._cubes(rows, columns)):
            low, never = self._low(rows, columns)
            self._skip(rows, columns, low, never)
        if len(new):  # the k that look nearest bound the k-th distance
            some = np.argpartition(low[new], self.k - 1, axis=1)[:, :self.k]
            row, at = np.repeat(new, self.k), some.ravel()
            there = low[row, at] < never
            row, at = row[there], at[there]
            self._merge(rows[row], columns[at])
            low[row, at] = never
            if self.kind == "product" and self.a.dtype == np.float32 and (
                    self.slack > 0.05 * self.factor * np.median(self.limit[rows]) ** 2):
                self.cubes = None
                self._product(np.float64)  # too coarse for the limits
                low = self._low(rows, columns)[0]
                self._skip(rows, columns, low, never)
                low[row, at] = never
            if self.kind == "product" and self.cubes is not None and (cubes := self._cubes(rows, columns)):
                cubes[0][row, at] = np.inf
        if cubes:
            low, most = cubes
            self._skip(rows, columns, low, np.inf)
            most = np.nextafter(np.minimum(most, 1e38).astype(np.float32), np.float32(np.inf))
        else:
            most = self._most(self.limit[rows])
        row, at = np.divmod(np.flatnonzero(low <= most[:, None]), len(columns))
        self._merge(rows[row], columns[at])

    def _merge(self, row: np.ndarray, column: np.ndarray) -> None:
        dist = np.empty(len(row))
        step = max(1, 1_000_000 // max(1, self.x.shape[1]))
        for s in range(0, len(row), step):
            a, b = self.x[row[s:s + step]], self.y[column[s:s + step]]
            dist[s:s + step] = np.round(_distances(a, b, self.r, pairs=True), DIGITS)
        keep = (dist <= self.limit[row]) & np.isfinite(dist)
        row, column, dist = row[keep], column[keep], dist[keep]
        if not len(row):
            return
        some = np.unique(row)
        row = np.concatenate([np.repeat(some, self.k), row])
        column = np.concatenate([self.column[some].ravel(), column])
        dist = np.concatenate([self.dist[some].ravel(), dist])
        order = np.lexsort((column, dist, row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        self.dist[some], self.column[some] = dist[order].reshape(-1, self.k), column[order].reshape(-1, self.k)
        self.limit[some] = np.minimum(self.limit[some], self.dist[some, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(np.isfinite(self.dist))
        return row, self.column[row, place], self.dist[row, place]


def rank_neighbours(found: DataFrame, k: int, by: Sequence[str] = ()) -> DataFrame:
    """Best k of candidate neighbours (at most k per visited block)."""
    w = Window.partitionBy(*by, "test_id").orderBy("distance", "train_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        *by, "test_id", "rank", "train_id", "distance", "label")


# ---- voting --------------------------------------------------------------------------
def _tally(neighbours: DataFrame, by: Sequence[str]) -> DataFrame:
    return neighbours.groupBy(*by, "test_id", "label").agg(
        F.count("*").alias("votes"), F.min("rank").alias("first"))


def _winner(tally: DataFrame, by: Sequence[str], tie: str) -> DataFrame:
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col(tie).alias("t"), F.col("label").alias("l")))
    return tally.groupBy(*by, "test_id").agg(best.alias("_w")).select(
        *by, "test_id", F.col("_w.l").alias("predicted"))


def _within(neighbours: DataFrame, k: int | Column | None) -> DataFrame:
    return neighbours if k is None else neighbours.where(F.col("rank") <= k)


def vote_majority(neighbours: DataFrame, k: int | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent class; on a tie the class met first among the neighbours."""
    return _winner(_tally(_within(neighbours, k), by), by, "first")


def vote_majority_label(neighbours: DataFrame, k: int | Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent class; on a tie the smallest label."""
    return _winner(_tally(_within(neighbours, k), by), by, "label")


def vote_plurality(neighbours: DataFrame, k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """On a tie the farthest neighbour leaves until one class leads; a single
    neighbour always decides."""
    n = _within(neighbours, k)
    last = k if isinstance(k, Column) else F.lit(k)
    # every prefix 1..k of the (at most k) neighbours of a test row
    prefixes = n.select(*by, "test_id", "rank", "label", F.explode(F.sequence(F.col("rank"), last)).alias("prefix"))
    counts = prefixes.groupBy(*by, "test_id", "prefix", "label").agg(F.count("*").alias("votes"))
    lead = counts.groupBy(*by, "test_id", "prefix").agg(
        F.max("votes").alias("top"), F.max_by("label", "votes").alias("label"),
        F.sort_array(F.collect_list("votes"), asc=False).alias("v"))
    clear = lead.where((F.size("v") == 1) | (F.get("v", F.lit(0)) > F.get("v", F.lit(1))))
    return clear.groupBy(*by, "test_id").agg(F.max_by("label", "prefix").alias("predicted"))


VOTES = {"most_voted": vote_majority, "most_label": vote_majority_label, "plurality": vote_plurality}


def classify(train: DataFrame, test: DataFrame, k: int, r: int = 2, vote: str = "most_voted", **kw) -> DataFrame:
    by = kw.get("by", ())
    return VOTES[vote](knn(train, test, k, r, **kw), k, by=by)
