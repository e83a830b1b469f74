"""Removal of byte strings that repeat anywhere in the corpus, by suffix sorting.

A string of ``length`` bytes is a window.  Of all windows only those are sorted
that may repeat:

1. Every window has an anchor, the leftmost of its k-grams with the least hash,
   so equal windows have equal anchors at equal offsets.  Neighbouring windows
   with one anchor form a context.  Anchors that stand once in the corpus end here.
2. Contexts that are equal as a whole repeat in all their windows.
3. The others of an anchor are sorted by what follows the anchor and, read
   backwards, by what comes before it, both times deep-shallow: multikey
   quicksort over 8-byte symbols to a shallow depth, then a blind trie for each
   group with a longer common prefix.  From the two orders and their common
   prefixes it follows exactly which windows occur twice.

Bytes of all repeating windows are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import mix, slices, stored
from tabulon.llm.graph import map_groups

#: Bytes of a repeating string, and of the k-grams that anchor it.
LENGTH, GRAM = 400, 200
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 32
#: Bits of the filters that pick contexts: their fixed size is what is broadcast.
FILTER_BITS = 27
#: An anchor with more different contexts than this is not sorted in one task:
#: its windows meet one by one, by 128-bit hashes.
HOT_CONTEXTS = 20_000
_SLICE = 4 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE_BITS = 28


class Anchors:
    """Anchors of texts; keeps powers of the hash base."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.up = self.down = np.ones(1, _U)

    def _powers(self, n: int):
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down

    def of(self, body: bytes):
        """(keys, contexts, first window, windows, anchor - first window, sums) or
        None for a text that is shorter than a window."""
        n = len(body)
        if n < self.length:
            return None
        if n >= 1 << _PLACE_BITS:
            raise ValueError("a text has 2**28 bytes or more")
        data = np.frombuffer(body, np.uint8)
        up, down = self._powers(n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * up[:n], out=sums[1:])
        grams = mix((sums[self.gram:] - sums[:-self.gram]) * down[:n - self.gram + 1])
        # the place in the low bits settles ties to the left
        low = _U((1 << _PLACE_BITS) - 1)
        value = (grams & ~low) | np.arange(len(grams), dtype=_U)
        w, windows = self.length - self.gram + 1, n - self.length + 1
        blocks = -(-len(value) // w)
        padded = np.full(blocks * w, ~_U(0), _U)
        padded[:len(value)] = value
        grid = padded.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(back[:windows], ahead[w - 1:w - 1 + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(first, windows))
        place = anchor[first]
        stop = first + count - 1 + self.length
        inside = (sums[stop] - sums[first]) * down[first]
        context = mix(inside + mix((place - first).astype(_U) * _U(1 << 20) + count.astype(_U)))
        return grams[place], context, first, count, place - first, (sums, down)


def _packed(first, count, offset) -> np.ndarray:
    return (first << 20) | (count << 10) | offset


def _digest(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def _halves(ds: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(b"".join(d[:16] for d in ds), ">i8").reshape(-1, 2).astype(np.int64)
    return a[:, 0], a[:, 1]


def _distinct_texts(part: pa.RecordBatch):
    return dict.fromkeys(t for t in part.column("t").to_pylist() if t)


def _occurrences(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """``key, context, d1, d2, at``: every context of every text (by its digest;
    copies within a slice once)."""

    def run(batches):
        anchors = Anchors(length, gram)
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                cols, ds, reps = [[], [], []], [], []
                for t in _distinct_texts(part):
                    found = anchors.of(t)
                    if found is None:
                        continue
                    key, context, first, count, offset, _ = found
                    for c, v in zip(cols, (key, context, _packed(first, count, offset)), strict=True):
                        c.append(v)
                    ds.append(_digest(t))
                    reps.append(len(key))
                if ds:
                    d1, d2 = _halves(ds)
                    arrays = [np.concatenate(cols[0]).view(np.int64), np.concatenate(cols[1]).view(np.int64),
                              np.repeat(d1, reps), np.repeat(d2, reps), np.concatenate(cols[2])]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["key", "context", "d1", "d2", "at"])

    return bodies.mapInArrow(run, "key long, context long, d1 long, d2 long, at long")


def _judged(occurrences: DataFrame) -> DataFrame:
    """Occurrences that may hold repeats.  ``whole``: the context occurs twice, so
    all of it repeats.  Otherwise its anchor has other contexts.  A last row for
    each such anchor (no digest) tells how many contexts it has.

    Rows stream by in order, so an anchor that a third of all texts share needs
    no memory."""
    ordered = occurrences.repartition("key").sortWithinPartitions("key", "context", "d1", "d2", "at")

    def run(batches):
        key = context = None
        held = None  # the only row so far of the open context
        waiting = None  # the first context of the anchor while it is the only one
        contexts, repeated = 0, False
        out: list[tuple] = []

        def close_context(more: bool):
            # more: the anchor has another context
            nonlocal waiting
            if context is None:
                return
            if held is not None and not repeated:
                if more or contexts > 1:
                    out.append((key, context, *held, False))
                else:
                    waiting = (key, context, *held, False)

        def close_key():
            nonlocal waiting, contexts
            close_context(False)
            if contexts > 1:
                out.append((key, None, None, None, contexts, False))
            waiting, contexts = None, 0

        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            k = cols[0]
            busy = np.zeros(len(k), bool)
            busy[1:] |= k[1:] == k[:-1]
            busy[:-1] |= k[1:] == k[:-1]
            if len(k):
                busy[0] = busy[-1] = True
            for row in zip(*(c[busy].tolist() for c in cols), strict=True):
                if row[0] != key:
                    close_key()
                    key, context, held, repeated, contexts = row[0], row[1], row[2:], False, 1
                elif row[1] != context:
                    close_context(True)
                    if waiting is not None:
                        out.append(waiting)
                        waiting = None
                    context, held, repeated = row[1], row[2:], False
                    contexts += 1
                elif repeated:
                    if row[2:] != held:
                        out.append((key, context, *row[2:], True))
                        held = row[2:]
                elif row[2:] != held:
                    out.append((key, context, *held, True))
                    out.append((key, context, *row[2:], True))
                    held, repeated = row[2:], True
            yield _judged_batch(out)
            out.clear()
        close_key()
        yield _judged_batch(out)

    return ordered.mapInArrow(run, "key long, context long, d1 long, d2 long, at long, whole boolean")


def _judged_batch(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * 6
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=["key", "context", "d1", "d2", "at", "whole"])


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Bit set of the column ``key``; Spark ORs its words together, so at most
    ``2**FILTER_BITS`` bits reach the driver however many keys there are.  A
    filter that fills up lets more contexts through and loses none."""

    def run(batches):
        for batch in batches:
            spot = _spread(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array((spot >> 5).astype(np.int32)), pa.array(np.int64(1) << (spot & 31))],
                                             names=["w", "m"])

    got = keys.select("key").mapInArrow(run, "w int, m long").groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    bits[got.column("w").to_numpy()] = got.column("m").to_numpy().astype(np.uint32)
    return bits


def _spread(keys: np.ndarray) -> np.ndarray:
    """Place of a key in a filter."""
    return (mix(keys.view(np.uint64)) >> _U(64 - FILTER_BITS)).astype(np.int64)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = _spread(keys)
    return ((bits[spot >> 5] >> (spot & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Patricia tree over strings: inner nodes know only how deep they branch.

    A string walks down blindly by its branch bytes to some leaf, one comparison
    with that leaf gives the true common prefix, and the leaf is inserted where
    it ends.  Walking the tree in byte order gives the sorted strings.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    @staticmethod
    def _branch(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def add(self, i: int):
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(self._branch(s, depth)) or next(iter(children.values()))
        other = self.strings[node[0]]
        common = _lcp(s, other)
        if common == len(s) == len(other):
            node.append(i)
            return
        parent, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            parent, node = node, node[1][self._branch(s, node[0])]
        branch = self._branch(s, common)
        if isinstance(node, tuple) and node[0] == common:
            node[1][branch] = [i]
            return
        inner = (common, {self._branch(other, common): node, branch: [i]})
        if parent is None:
            self.root = inner
        else:
            parent[1][self._branch(s, parent[0])] = inner

    def walk(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out += node
        return out


def deep_shallow(strings: list[bytes], items: list[int], shared: int = 0, shallow: int = SHALLOW) -> list[int]:
    """``items`` in the order of their strings, which share ``shared`` bytes."""
    out: list[int] = []
    stack = [(items, shared)]
    while stack:
        items, depth = stack.pop()
        if len(items) < 2:
            out += items
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in items:
                trie.add(i)
            out += trie.walk()
        else:
            pivot = strings[items[len(items) // 2]][depth:depth + 8]
            less, same, more = [], [], []
            for i in items:
                symbol = strings[i][depth:depth + 8]
                (same if symbol == pivot else less if symbol < pivot else more).append(i)
            # a symbol cut short is the end of its strings: they are equal
            stack.append((more, depth))
            stack.append((same, depth + 8 if len(pivot) == 8 else shallow))
            stack.append((less, depth))
    return out


def _ranked(strings: list[bytes], groups: list[list[int]], shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every string (group by group) and the common prefix with the one
    of the rank before, -1 where a group begins."""
    rank = np.zeros(len(strings), np.int64)
    common = np.full(len(strings), -1, np.int64)
    at = 0
    for items in groups:
        order = deep_shallow(strings, items, shared)
        for k, i in enumerate(order):
            rank[i] = at
            if k:
                common[at] = _lcp(strings[order[k - 1]], strings[i])
            at += 1
    return rank, common


def repeating(keys: np.ndarray, texts: list[bytes], counts: np.ndarray, offsets: np.ndarray,
              length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(context, begin, end): runs of windows that another context of the same key
    has too.  Contexts of a key are different."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    groups = [g.tolist() for g in np.split(order, cuts)]
    groups = [g for g in groups if len(g) > 1]
    right = [t[o:] for t, o in zip(texts, offsets.tolist(), strict=True)]
    left = [t[:o][::-1] for t, o in zip(texts, offsets.tolist(), strict=True)]
    some = np.array([i for g in groups for i in g], np.int64)
    if not len(some):
        return []
    # equal keys mean equal k-grams but for a collision of hashes, which the test excludes
    agree = all(right[g[0]][:gram] == right[i][:gram] for g in groups for i in g[1:])
    rank_r, common_r = _ranked(right, groups, gram if agree else 0)
    rank_l, common_l = _ranked(left, groups, 0)
    found = np.zeros((len(texts), length - gram + 1), bool)
    for before in range(length - gram + 1):
        active = some[(before <= offsets[some]) & (before > offsets[some] - counts[some])]
        if len(active) < 2:
            continue
        # neighbours in an order agree as far as the least common prefix between them
        class_r = np.cumsum(common_r < length - before)[rank_r[active]]
        class_l = np.cumsum(common_l < before)[rank_l[active]]
        both = class_r * (len(texts) + 1) + class_l
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        hit = np.zeros(len(by), bool)
        hit[1:] |= same
        hit[:-1] |= same
        x = active[by[hit]]
        found[x, offsets[x] - before] = True  # by the window's place in its context
    out = []
    for i in np.flatnonzero(found.any(axis=1)).tolist():
        edge = np.flatnonzero(np.diff(np.concatenate([[False], found[i], [False]]).astype(np.int8)))
        out += [(i, a, b) for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]
    return out


def _contexts(bodies: DataFrame, mixed: np.ndarray, hot: np.ndarray, length: int, gram: int) -> DataFrame:
    """Text of each context of an anchor that has several; hot anchors give the
    hashes of single windows instead (``w1``, ``w2``, with the window's place in
    ``offset``)."""
    sent = bodies.sparkSession.sparkContext.broadcast((mixed, hot))

    def run(batches):
        anchors, (mixed_bits, hot_bits) = Anchors(length, gram), sent.value
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                seen, out = set(), [[] for _ in range(7)]
                for t in _distinct_texts(part):
                    found = anchors.of(t)
                    if found is None:
                        continue
                    key, context, first, count, offset, _ = found
                    use = np.flatnonzero(_passes(mixed_bits, key.view(np.int64)))
                    is_hot = _passes(hot_bits, key.view(np.int64)[use])
                    picked = (key.view(np.int64)[use], context.view(np.int64)[use], first[use], count[use], offset[use], is_hot)
                    for k, c, s, n, o, h in zip(*(x.tolist() for x in picked), strict=True):
                        if (k, c) in seen:
                            continue
                        seen.add((k, c))
                        rows = [(k, c, n, o, t[s:s + n - 1 + length], None, None)] if not h else [
                            (k, c, 1, j, None, *_window_hash(t[s + j:s + j + length])) for j in range(n)]
                        for row in rows:
                            for col, v in zip(out, row, strict=True):
                                col.append(v)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                                 names=["key", "context", "n", "offset", "body", "w1", "w2"])

    return bodies.mapInArrow(run, "key long, context long, n int, offset int, body binary, w1 long, w2 long")


def _window_hash(window: bytes) -> list[int]:
    return np.frombuffer(hashlib.blake2b(window, digest_size=16).digest(), np.int64).tolist()


def _repeating_runs(contexts: DataFrame, any_hot: bool, length: int, gram: int) -> DataFrame:
    """``key, context, begin, end``: runs of repeating windows within contexts."""

    def sort(group: pa.Table):
        key, context = group.column("key").to_numpy(), group.column("context").to_numpy()
        keep = np.ones(len(key), bool)  # several slices may have sent one context
        keep[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
        rows = np.flatnonzero(keep)
        bodies = group.column("body").take(pa.array(rows)).to_pylist()
        n, offset = (group.column(c).to_numpy()[rows].astype(np.int64) for c in ("n", "offset"))
        found = np.array(repeating(key[rows], bodies, n, offset, length, gram), np.int64).reshape(-1, 3)
        at = rows[found[:, 0]]
        yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(context[at]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                         names=["key", "context", "begin", "end"])

    runs = map_groups(contexts.where("w1 is null").select("key", "context", "n", "offset", "body"), ["key"],
                      "key long, context long, begin long, end long", sort, order=["context"], at_once=10_000)
    if any_hot:
        single = contexts.where("w1 is not null").select("key", "context", "offset", "w1", "w2")
        twice = single.groupBy("w1", "w2").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a < b")
        met = single.join(twice, ["w1", "w2"]).select("key", "context", F.col("offset").cast("long").alias("begin"))
        runs = runs.union(met.distinct().withColumn("end", F.col("begin") + 1))
    return runs


def spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
          hot: int = HOT_CONTEXTS) -> DataFrame:
    """``d1, d2, runs``: for texts (by the first 16 bytes of their SHA-256) the
    runs of windows that stand elsewhere too.  Copies of a whole text are not
    counted against each other here."""
    bodies = docs.select(F.col(text).cast("binary").alias("t"))
    judged = stored(_judged(_occurrences(bodies, length, gram)), "judged")
    many = judged.where("context is null")
    hot_bits = _filter_of(many.where(F.col("at") > hot))
    contexts = _contexts(bodies, _filter_of(many), hot_bits, length, gram)
    runs = _repeating_runs(contexts, bool(hot_bits.any()), length, gram)
    first, count = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023)
    found = judged.where("context is not null")
    whole = found.where("whole").select("d1", "d2", first.alias("begin"), (first + count).alias("end"))
    part = found.where("not whole").join(runs, ["key", "context"]).select(
        "d1", "d2", (first + F.col("begin")).alias("begin"), (first + F.col("end")).alias("end"))
    return whole.union(part).groupBy("d1", "d2").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))


def _removed(body: bytes, runs: list[dict], length: int) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs, what is left)."""
    kept, removed, n, at = [], 0, 0, 0
    begin = end = -1
    for r in sorted((r["begin"], r["end"] - 1 + length) for r in runs):
        if r[0] <= end:
            end = max(end, r[1])
            continue
        if end > 0:
            kept.append(body[at:begin])
            removed, n, at = removed + end - begin, n + 1, end
        begin, end = r
    if end > 0:
        kept.append(body[at:begin])
        removed, n, at = removed + end - begin, n + 1, end
    return removed, n, b"".join([*kept, body[at:]])


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
           hot: int = HOT_CONTEXTS, keep_bytes: bool = False) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row,
    and ``kept`` (the bytes left) on request.

    Null counts as empty; texts shorter than ``length`` lose nothing; matches
    never cross rows.  Rows with one text of at least ``length`` bytes lose all
    of it, repeated rows included.  ``gram`` bytes must fit in a window.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sha = F.sha2(body, 256)
    half = lambda k: F.conv(F.substring(sha, 1 + 16 * k, 16), 16, -10).cast("long")
    base = docs.select(F.col(key).alias("k"), F.length(body).cast("long").alias("n_bytes"), sha.alias("sha"),
                       half(0).alias("d1"), half(1).alias("d2"), *([body.alias("own")] if keep_bytes else []))
    copied = base.where(F.col("n_bytes") >= length).groupBy("d1", "d2").agg(F.count("*").alias("c")).where("c > 1").select(
        "d1", "d2", F.lit(True).alias("copied"))
    found = stored(spans(docs, text, length, gram, hot).join(copied, ["d1", "d2"], "left_anti"), "spans")
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_of(found.select(F.col("d1").alias("key"))))

    def pick(batches):
        bits = wanted.value
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                texts = [t for t in _distinct_texts(part) if len(t) >= length]
                d1, d2 = _halves([_digest(t) for t in texts])
                use = np.flatnonzero(_passes(bits, d1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1[use]), pa.array(d2[use]), pa.array([texts[i] for i in use.tolist()], pa.binary())],
                    names=["d1", "d2", "t"])

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "t", _SLICE):
                rows = [_removed(t, r, length) for t, r in zip(part.column("t").to_pylist(), part.column("runs").to_pylist(),
                                                               strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("d1"), part.column("d2"), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                     pa.array([r[2] if keep_bytes else None for r in rows], pa.binary())],
                    names=["d1", "d2", "r", "s", "h", "kept"])

    texts = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(pick, "d1 long, d2 long, t binary")
    results = texts.join(found, ["d1", "d2"]).select("d1", "d2", "t", "runs").mapInArrow(
        cut, "d1 long, d2 long, r long, s long, h string, kept binary")
    if keep_bytes:
        results = results.groupBy("d1", "d2").agg(*[F.first(c).alias(c) for c in ("r", "s", "h", "kept")])
    else:
        results = results.drop("kept").distinct()
    joined = base.join(copied, ["d1", "d2"], "left").join(results, ["d1", "d2"], "left")
    all_ = F.coalesce("copied", F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    out = [F.col("k").alias(key), "n_bytes", F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).alias("n_removed"),
           F.when(all_, F.lit(1)).otherwise(F.coalesce("s", F.lit(0))).cast("long").alias("n_spans"),
           F.when(all_, F.lit(nothing)).otherwise(F.coalesce("h", "sha")).alias("kept_sha256")]
    if keep_bytes:
        out.append(F.when(all_, F.lit(b"")).otherwise(F.coalesce("kept", "own")).alias("kept"))
    return joined.select(*out)
