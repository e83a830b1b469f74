"""Exact Jaccard join of word shingles, found through count vectors.

1. Every text becomes a set of shingle hashes; equal sets are one node.
2. Nodes can only link if they share a shingle among the first of their sets in
   one global order, rare ones first (prefix filter), and their sizes differ by
   a quarter at most.  The nodes of a shingle and a range of sizes are a list,
   equal lists are one, and lists are the blocks; no pair is formed.
3. In a block, shingles are hashed into groups and every node is a point: how
   many of its shingles fall into each group.  An R-tree over the points bounds
   the overlap of two boxes or points by the sum of coordinate-wise minima, so
   subtrees and pairs that cannot reach the similarity fall away.
4. The sets of surviving nodes are compared in full.

Only a spanning forest of links is kept; components follow by contraction.
Sizes differ by a factor of 1.25 at most within a link, so lists hold two
neighbouring size bands (a window).  Lists are not joined to larger groups:
these would grow with the data, as any two texts that have one rare shingle in
common chain them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import fresh, light_batches, map_text, mix, slices, stored
from tabulon.llm.graph import components, map_groups

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 80
#: Of the texts whose hash is 0 modulo this, shingles are counted to put common
#: ones last in the global order.  Any order gives the same links.
ORDER_SAMPLE, ORDER_LEAST, ORDER_MOST = 32, 3, 1_000_000
#: Nodes of a block; larger lists and groups are dealt to pairs of chunks.
POINT_CHUNK, SET_CHUNK = 4096, 2048
#: Rows of a shingle that are held to find equal lists; beyond, they stream by.
HELD_ROWS = 1 << 20
#: Rows of small lists that are compared at once, and bytes of their points.
LIST_ROWS, PAIR_BYTES = 2048, 4 << 20
#: Points of a leaf, children of an inner box.
LEAF = 32
#: Node ids that may be broadcast to pick texts (8 bytes each); beyond, they are joined.
BROADCAST_NODES = 4_000_000
_SLICE = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


class Hasher:
    """Shingle sets of a list of texts, by prefix sums over their joined bytes."""

    def __init__(self, words: int = WORDS):
        self.k, self.up, self.down = words, np.ones(1, _U), np.ones(1, _U)

    def _powers(self, n: int):
        if len(self.up) < n:
            n = max(n, _SLICE + (_SLICE >> 1))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text (A-Z lowered, words between
        spaces and \\x09-\\x0D).  Fewer words than a shingle are one; no words,
        none."""
        bodies = [(t or b"").lower() for t in texts]
        joined = b"\n".join(bodies) + b"\n"
        data = np.frombuffer(joined, np.uint8)
        up, down = self._powers(len(data) + 1)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
        starts, ends = edge[0::2], edge[1::2]
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * up[:len(data)], out=sums[1:])
        word = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
        begins = np.cumsum([0, *(len(b) + 1 for b in bodies)])
        first = np.searchsorted(starts, begins)  # first word of each text
        count = np.diff(first)
        out = [np.zeros(0, _U)] * len(texts)
        if len(word) >= self.k:
            roll = np.zeros(len(word) - self.k + 1, _U)
            for j in range(self.k):
                roll = roll * _U(_BASE) + word[j:len(word) - self.k + 1 + j]
            roll = mix(roll)
        for i, n in enumerate(count.tolist()):
            a = first[i]
            if n >= self.k:
                out[i] = np.unique(roll[a:a + n - self.k + 1])
            elif n:
                h = _U(n)
                for w in word[a:a + n]:
                    h = (h ^ w) * _U(_BASE)
                out[i] = mix(np.array([h], _U))
        return out


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _bands() -> np.ndarray:
    """First sizes of the bands: a band and the next hold every partner of a size."""
    t = [1]
    while t[-1] < 1 << 40:
        t.append(t[-1] * 5 // 4 + 1)
    return np.array(t)


BANDS = _bands()


def groups_of(window: int) -> int:
    """Number of count groups in a window: about four shingles a group."""
    low = int(BANDS[max(window, 0)])
    return max(8, 1 << max(0, low // 4).bit_length())


def _band(n: int) -> int:
    return int(np.searchsorted(BANDS, n, side="right")) - 1


def needed(a, b, percent: int = PERCENT):
    """Least intersection of a link between sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def _node(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def nodes(docs: DataFrame, text: str, key: str, words: int = WORDS) -> DataFrame:
    """``key``, ``n``, ``digest``, ``node`` (its first bytes) and ``points`` of every text."""

    def run(batches):
        h = Hasher(words)
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                n, ds, ids, points = [], [], [], []
                for s in h.sets(part.column("t").to_pylist()):
                    d = digest(s)
                    n.append(len(s))
                    ds.append(d)
                    ids.append(_node(d))
                    g = groups_of(_band(len(s))) if len(s) else 0
                    points.append(np.bincount((s & _U(g - 1)).astype(np.intp), minlength=g).astype(np.uint16).tobytes()
                                  if g else b"")
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(n, pa.int64()), pa.array(ds, pa.binary()),
                                                  pa.array(ids, pa.int64()), pa.array(points, pa.binary())],
                                                 names=["k", "n", "digest", "node", "points"])

    kind = docs.schema[key].dataType.simpleString()
    base = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
    return base.mapInArrow(run, f"k {kind}, n long, digest binary, node long, points binary")


def common_shingles(docs: DataFrame, text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of the distinct texts says are common, sorted, and
    their counts; at most ``ORDER_MOST``.  Copies of one text count once a slice."""
    body = F.col(text).cast("binary").alias("t")
    sample = docs.where(F.pmod(F.xxhash64(text, F.lit("order")), F.lit(ORDER_SAMPLE)) == 0).select(body)

    def run(batches):
        h = Hasher(words)
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                found = h.sets(list(dict.fromkeys(part.column("t").to_pylist())))
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate([np.zeros(0, _U), *found]))], names=["s"])

    rows = (sample.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= ORDER_LEAST)
            .orderBy(F.desc("count"), "s").limit(ORDER_MOST).toArrow())
    found = rows.column("s").to_numpy().view(np.uint64)
    order = np.argsort(found)
    return found[order], np.minimum(rows.column("count").to_numpy()[order], 1 << 30).astype(np.int32)


def _prefixes(docs: DataFrame, text: str, common: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """``shingle, node, n`` for the first shingles of each set, common ones last,
    the most common at the end."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        h, (last, often) = Hasher(words), sent.value
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                picked, ids, sizes, seen = [np.zeros(0, _U)], [], [], set()
                for s in h.sets(part.column("t").to_pylist()):
                    d = digest(s)
                    if not len(s) or d in seen:
                        continue
                    seen.add(d)
                    keep = len(s) - -(-percent * len(s) // 100) + 1
                    if len(last):
                        place = np.minimum(np.searchsorted(last, s), len(last) - 1)
                        late = last[place] == s
                        s_ordered = s[~late]
                        if len(s_ordered) < keep:
                            rest = np.argsort(often[place[late]], kind="stable")
                            s_ordered = np.concatenate([s_ordered, s[late][rest]])
                    else:
                        s_ordered = s
                    picked.append(s_ordered[:keep])
                    ids.append(_node(d))
                    sizes.append((len(s), keep))
                reps = [k for _, k in sizes]
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(picked)), pa.array(np.repeat(np.array(ids, np.int64), reps)),
                     pa.array(np.repeat(np.array([n for n, _ in sizes], np.int32), reps))], names=["shingle", "node", "n"])

    return docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(run, "shingle long, node long, n int")


def _runs(s: np.ndarray, n: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``list, w, m, node`` from whole shingles, their rows ordered by size: a
    list is a run of at least two nodes of one window without too large a step
    in size, named by what it holds.  Of a run within one band only that of the
    window which begins with it is kept."""
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (node[1:] != node[:-1])
    s, n, node = s[new], n[new], node[new]
    shingle = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.intp)
    # rows that are alone with their shingle never need a look
    busy = np.bincount(shingle)[shingle] > 1 if len(s) else np.zeros(0, bool)
    n, node, shingle = n[busy].astype(np.int64), node[busy], shingle[busy]
    window = np.searchsorted(BANDS, n, side="right") - 1
    # the lower band of its window, then the upper one of the window before
    at = np.concatenate([shingle * 256 + window + 1, shingle * 256 + window])
    order = np.argsort(at, kind="stable")
    at, size, node = at[order], np.tile(n, 2)[order], np.tile(node, 2)[order]
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1]) | (4 * size[1:] > 5 * size[:-1])
    start = np.flatnonzero(opens)
    m = np.diff(np.append(start, len(at)))
    keep = (m > 1) & (order < len(n))[start]
    if not keep.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = (at[start] % 256 - 1)
    ids = mix(np.add.reduceat(mix(node.view(_U)), start) + mix(w.view(_U) + _U(1))).view(np.int64)
    m, rows = m[keep], np.repeat(keep, m)
    return np.repeat(ids[keep], m), np.repeat(w[keep], m).astype(np.int32), np.repeat(m, m), node[rows]


def _streamed(s: np.ndarray, n: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``list, w, m, node`` of some rows of a shingle too common to be held: one
    list a window, of unknown length (-1)."""
    band = np.searchsorted(BANDS, n, side="right") - 1
    w = np.concatenate([band, band - 1])
    ids = mix(np.tile(s, 2).view(_U) + mix(w.astype(np.int64).view(_U) + _U(1))).view(np.int64)
    return ids, w.astype(np.int32), np.full(len(w), -1, np.int64), np.tile(node, 2)


def _lists(prefixes: DataFrame) -> DataFrame:
    """Rows ``list, w, m, node`` of the lists of nodes of one window that share a
    shingle; ``m`` is their length, or -1 if the list is too long to be held."""
    ordered = prefixes.repartition("shingle").sortWithinPartitions("shingle", "n", "node")

    def run(batches):
        held, huge = [], None

        def batch_of(cols):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["list", "w", "m", "node"])

        for batch in batches:
            s, node, n = (batch.column(i).to_numpy() for i in range(3))
            if huge is not None:  # the shingle that streams by
                end = int(np.searchsorted(s, huge, side="right"))
                yield batch_of(_streamed(s[:end], n[:end], node[:end]))
                s, node, n = s[end:], node[end:], n[end:]
                if not len(s):
                    continue
                huge = None
            if not len(s):
                continue
            last = int(np.searchsorted(s, s[-1], side="left"))  # its rows may go on in the next batch
            if last or (held and held[-1][0][-1] != s[-1]):
                held.append((s[:last], n[:last], node[:last]))
                yield batch_of(_runs(*map(np.concatenate, zip(*held, strict=True))))
                held = []
            held.append((s[last:], n[last:], node[last:]))
            if sum(len(h[0]) for h in held) > HELD_ROWS:
                huge = s[-1]
                for h in held:
                    yield batch_of(_streamed(*h))
                held = []
        if held:
            yield batch_of(_runs(*map(np.concatenate, zip(*held, strict=True))))

    return ordered.mapInArrow(run, "list long, w int, m long, node long").distinct()


def _chunked(members: DataFrame, labels: list[str], id_: str, size: int, known: str | None = None) -> DataFrame:
    """Members with the blocks (``labels, i, j``) they stand in.  Groups of up to
    ``size`` members are one block; larger ones are dealt by a hash into chunks,
    and every pair of chunks is a block.  ``known``: column with the size of the
    group, if positive."""
    unknown = members if known is None else members.where(F.col(known) <= 0)
    count = unknown.groupBy(*labels).agg(F.count("*").alias("_m"))
    placed = unknown.join(count, labels)
    if known is not None:
        placed = placed.unionByName(members.where(F.col(known) > 0).withColumn("_m", F.col(known)))
    placed = placed.withColumn("_k", F.ceil(F.col("_m") / size).cast("int")).withColumn(
        "_c", F.pmod(F.xxhash64(F.col(id_), F.lit("chunk")), F.col("_k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_o")
    return placed.select("*", other).withColumns(
        {"i": F.least("_c", "_o"), "j": F.greatest("_c", "_o")}).drop("_m", "_k", "_o")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


class RTree:
    """Points packed by median splits along the widest coordinate; boxes keep
    upper corners, the least size in them and their points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.leaves = self._split(np.arange(len(points)))
        levels = [[(points[x].max(axis=0), int(sizes[x].min()), int(sizes[x].max()), (k,)) for k, x in enumerate(self.leaves)]]
        while len(levels[-1]) > 8:
            below, row = levels[-1], []
            for k in range(0, len(below), 8):
                some = below[k:k + 8]
                row.append((np.max([c[0] for c in some], axis=0), min(c[1] for c in some), max(c[2] for c in some),
                            tuple(v for c in some for v in c[3])))
            levels.append(row)
        self.levels = levels

    def _split(self, x: np.ndarray) -> list[np.ndarray]:
        stack, out = [x], []
        while stack:
            x = stack.pop()
            if len(x) <= LEAF:
                out.append(x)
                continue
            p = self.points[x]
            axis = int(np.argmax(p.max(axis=0).astype(np.int32) - p.min(axis=0)))
            order = np.argsort(p[:, axis], kind="stable")
            stack += [x[order[len(x) // 2:]], x[order[:len(x) // 2]]]
        return out

    def leaf_pairs(self, percent: int):
        """Pairs of leaves whose boxes may hold a link, near ones first."""
        top = self.levels[-1]
        corners = [np.array([c[0] for c in level]) for level in (top, self.levels[0])]
        leaf = self.levels[0]
        lows = np.array([c[1] for c in leaf])
        highs = np.array([c[2] for c in leaf])
        for k in range(len(leaf)):
            yield k, k
        for k, (corner, low, high, _) in enumerate(leaf):
            # descend: upper boxes first, then the leaves below those that pass
            bound = np.minimum(corners[0], corner).sum(axis=1, dtype=np.int64)
            pass_top = [c for c, b in zip(top, bound, strict=True)
                        if b >= needed(c[1], low, percent) and 100 * c[2] >= percent * low and 100 * high >= percent * c[1]]
            below = np.array(sorted(v for c in pass_top for v in c[3] if v > k), np.intp)
            if not len(below):
                continue
            bound = np.minimum(corners[1][below], corner).sum(axis=1, dtype=np.int64)
            fits = (bound >= needed(lows[below], low, percent)) & (100 * highs[below] >= percent * low) & (
                100 * high >= percent * lows[below])
            for v in below[fits].tolist():
                yield k, v


def surviving(points: np.ndarray, sizes: np.ndarray, forest: Forest, side: np.ndarray | None, percent: int = PERCENT):
    """Pairs of positions whose bound allows a link and that the forest has not
    joined yet; joins them.  With ``side`` only pairs from different sides."""
    tree = RTree(points, sizes)
    for p, q in tree.leaf_pairs(percent):
        x, y = tree.leaves[p], tree.leaves[q]
        if side is not None and len(x) and len(y) and (side[x] == side[x[0]]).all() and (side[y] == side[x[0]]).all():
            continue
        bound = np.minimum(points[x][:, None, :], points[y][None, :, :]).sum(axis=2, dtype=np.int64)
        fits = bound >= needed(sizes[x][:, None], sizes[y][None, :], percent)
        if side is not None:
            fits &= side[x][:, None] != side[y][None, :]
        for i, j in zip(*np.nonzero(fits), strict=True):
            a, b = int(x[i]), int(y[j])
            if a != b and forest.join(a, b):
                yield a, b


def _matrix(points: list[bytes], g: int) -> np.ndarray:
    """Points of a window as rows; those of the upper band may have finer groups."""
    out, lengths = np.empty((len(points), g), np.uint16), np.array([len(p) for p in points], np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        fine = np.frombuffer(b"".join([points[r] for r in rows.tolist()]), np.uint16).reshape(len(rows), -1, g)
        out[rows] = fine.sum(axis=1)
    return out


def close_pairs(points: np.ndarray, sizes: np.ndarray, group: np.ndarray, side: np.ndarray, percent: int = PERCENT):
    """Pairs of positions of one group whose bound allows a link, as two arrays;
    ``group`` is ascending.  Positions of sides that are not negative meet only
    other sides."""
    ends = np.searchsorted(group, group, side="right")
    reps = ends - np.arange(len(group)) - 1
    x = np.repeat(np.arange(len(group)), reps)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(reps) - reps, reps)
    apart = (side[x] < 0) | (side[x] != side[y])
    least = needed(sizes[x], sizes[y], percent)
    fits = apart & (np.minimum(sizes[x], sizes[y]) >= least)
    x, y, least = x[fits], y[fits], least[fits]
    passed, step = np.zeros(len(x), bool), max(1, PAIR_BYTES // max(1, 2 * points.shape[1]))
    for k in range(0, len(x), step):
        bound = np.minimum(points[x[k:k + step]], points[y[k:k + step]]).sum(axis=1, dtype=np.int64)
        passed[k:k + step] = bound >= least[k:k + step]
    return x[passed], y[passed]


def _point_edges(blocks: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between nodes whose points allow a link: a spanning forest
    of each block.  Lists of a leaf at most need no tree; many are compared at once."""
    keys = ["w", "list", "m", "i", "j"]

    def run(several: pa.Table):
        cols = [several.column(k).to_numpy() for k in keys]
        change = np.zeros(several.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        group, w, node, sizes = np.cumsum(change), cols[0], several.column("node").to_numpy(), several.column("n").to_numpy()
        side = np.where(cols[3] == cols[4], -1, several.column("_c").to_numpy())
        bytes_, count = several.column("points").to_pylist(), np.bincount(group)
        small = (count <= LEAF)[group]
        a, b = [], []
        for window in np.unique(w[small]).tolist():
            some = np.flatnonzero(small & (w == window))
            points = _matrix([bytes_[k] for k in some.tolist()], groups_of(window))
            x, y = close_pairs(points, sizes[some], group[some], side[some], percent)
            a.append(node[some[x]])
            b.append(node[some[y]])
        starts = np.searchsorted(group, np.arange(len(count) + 1))
        for k in np.flatnonzero(count > LEAF).tolist():
            some = slice(starts[k], starts[k + 1])
            points = _matrix(bytes_[some], groups_of(int(w[starts[k]])))
            sides = None if side[starts[k]] < 0 else side[some]
            found = list(surviving(points, sizes[some], Forest(len(points)), sides, percent))
            if found:
                x, y = np.array(found).T
                a.append(node[some][x])
                b.append(node[some][y])
        a, b = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
        names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest, x, y = Forest(len(names)), place[:len(a)].tolist(), place[len(a):].tolist()
        kept = np.array([forest.join(p, q) for p, q in zip(x, y, strict=True)], bool)
        yield pa.RecordBatch.from_arrays([pa.array(a[kept]), pa.array(b[kept])], names=["a", "b"])

    return map_groups(blocks, keys, "a long, b long", run, at_once=LIST_ROWS)


def set_links(sets: list[np.ndarray], side: np.ndarray | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning forest of the exact links of a block, by its inverted index."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    all_ = np.concatenate([np.zeros(0, _U), *sets])
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(all_, kind="stable")
    sorted_, owner = all_[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(all_) else np.zeros(0, np.intp)
    stops = np.append(starts[1:], len(all_)) if len(all_) else starts
    run = np.zeros(len(all_), np.intp)
    run[order] = np.repeat(np.arange(len(starts)), stops - starts)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    forest, out = Forest(m), []
    for x in range(m):
        mine = run[upto[x]:upto[x + 1]]
        a, n = starts[mine], (stops - starts)[mine]
        busy = n > 1
        a, n = a[busy], n[busy]
        if not len(a):
            continue
        ends = np.cumsum(n)
        met = owner[np.repeat(a - (ends - n), n) + np.arange(int(ends[-1]))]
        common = np.bincount(met, minlength=m)
        linked = 100 * common >= percent * (sizes[x] + sizes - common)
        linked[:x + 1] = False
        if side is not None:
            linked &= side != side[x]
        out += [(x, y) for y in np.flatnonzero(linked).tolist() if forest.join(x, y)]
    return out


def _links(docs: DataFrame, text: str, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``a, b`` (digests), a spanning forest of each block of nodes with one label."""
    spark = docs.sparkSession
    body = docs.select(F.col(text).cast("binary").alias("t"))
    wanted = None
    if labels.count() <= BROADCAST_NODES:
        ids = np.sort(labels.select("node").toArrow().column("node").to_numpy())
        wanted = spark.sparkContext.broadcast(ids)

    def run(batches):
        h, ids = Hasher(words), wanted.value if wanted is not None else None
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                seen: dict[bytes, np.ndarray] = {}
                for s in h.sets(part.column("t").to_pylist()):
                    d = digest(s)
                    if ids is not None:
                        k = np.searchsorted(ids, _node(d))
                        if k == len(ids) or ids[k] != _node(d):
                            continue
                    if len(s):
                        seen.setdefault(d, s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(_node, seen), pa.int64()), pa.array(list(seen), pa.binary()),
                     pa.array([s.tobytes() for s in seen.values()], pa.binary())], names=["node", "digest", "s"])

    sets = body.mapInArrow(run, "node long, digest binary, s binary").join(labels, "node")
    sets = sets.groupBy("digest").agg(F.first("root").alias("label"), F.first("s").alias("s"))
    blocks = _chunked(sets, ["label"], "digest", SET_CHUNK)

    def link(group: pa.Table):
        names = group.column("digest").to_pylist()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        side = None if i == j else group.column("_c").to_numpy()
        found = set_links([np.frombuffer(s, _U) for s in group.column("s").to_pylist()], side, percent)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([names[a] for a, _ in found], pa.binary()),
                                              pa.array([names[b] for _, b in found], pa.binary())], names=["a", "b"])

    return map_groups(blocks, ["label", "i", "j"], "a binary, b binary", link)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
            percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows ``k, n, digest`` of all documents, and ``digest, component`` of every
    set that is not empty: the smallest key reachable by links."""
    light_batches(docs.sparkSession)
    base = stored(nodes(docs, text, key, words), "nodes")
    common = common_shingles(docs, text, words)
    lists = stored(_lists(_prefixes(docs, text, common, words, percent)), "lists")
    single = base.where("n > 0").groupBy("digest").agg(
        F.first("node").alias("node"), F.first("n").alias("n"), F.first("points").alias("points")).drop("digest")
    blocks = _chunked(lists, ["list", "w", "m"], "node", POINT_CHUNK, "m").join(single, "node")
    points = _point_edges(blocks, percent)
    refined = stored(components(points), "refined")
    linked = components(_links(docs, text, refined, words, percent))
    least = base.where("n > 0").groupBy("digest").agg(F.min("k").alias("least"))
    roots = least.join(linked.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "root", F.coalesce("root", "digest"))
    top = roots.groupBy("root").agg(F.min("least").alias("component"))
    return base.select("k", "n", "digest"), roots.join(top, "root").select("digest", "component")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` of every row.

    Null, empty and wordless texts have no shingles and are linked with nothing:
    their component is their own key.  Rows with equal sets are linked.  A null
    key is ignored by the minimum; a component of null keys alone is null.
    """
    rows, found = classes(docs, key, text, words, percent)
    joined = rows.join(found, "digest", "left")
    return joined.select(F.col("k").alias(key), F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("k")).alias("component_id"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                percent: int = PERCENT) -> DataFrame:
    """One row of each component: the one whose key is the component's (of several
    rows with that key and one set, the first by text).  Texts without shingles
    all stay."""
    _, found = classes(docs, key, text, words, percent)
    n, d, c = (fresh(docs, x) for x in ("_n", "_set", "_component"))

    def make():
        h = Hasher(words)

        def kernel(texts):
            sets = h.sets(texts)
            return [len(s) for s in sets], [digest(s) for s in sets]

        return kernel

    marked = map_text(docs, text, [(n, "long"), (d, "binary")], make, _SLICE)
    kept = marked.join(found.select(F.col("digest").alias(d), F.col("component").alias(c)), d, "left").where(
        (F.col(n) == 0) | F.col(key).eqNullSafe(F.col(c)))
    again = fresh(kept, "_rank")
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy(d, F.coalesce(F.col(key).cast("string"), F.lit(""))).orderBy(text))
    # one set and one key: repeated rows; rows without shingles never compete
    unique = kept.where(F.col(n) > 0).withColumn(again, rank).where(F.col(again) == 1)
    return unique.select(*docs.columns).unionByName(kept.where(F.col(n) == 0).select(*docs.columns))
