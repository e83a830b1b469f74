"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items become windows of consecutive words.  A window is the byte
string ``" w1 w2 ... wn "`` of its words, so a hit can neither start nor end
inside a word, whatever stood between the words of the text.

Inside tasks the search follows Wu and Manber: of each window the first ``m``
bytes count, ``m`` being the shortest length of its tier; a shift table over
blocks of ``b`` bytes says how far a position may be skipped; where it says 0,
the hash bucket of the suffix block names the windows to test, and a direct
comparison of all bytes confirms.  Thousands of cursors walk through one buffer
side by side, so a step is a few numpy calls.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import fresh, map_text

#: Words of a window.
WINDOW = 10
#: Benchmark text (bytes) whose windows are broadcast at once; a larger
#: benchmark is searched in as many passes as it needs.
BLOCK_BYTES = 4 << 20
#: Windows from this many bytes on form a tier: (least length, block length).
TIERS = ((24, 8), (8, 4), (3, 2))
_TABLE_BITS = 20
_CURSORS = 8192
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                    for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text; null has none."""
    return (text or b"").translate(_WORD_BYTES).split()


def windows_of(text: bytes | None, size: int = WINDOW) -> set[bytes]:
    """Windows of an item; an item of fewer words than ``size`` is one window."""
    w = words_of(text)
    if not w:
        return set()
    return {b" " + b" ".join(w[i:i + size]) + b" " for i in range(max(1, len(w) - size + 1))}


class Tier:
    """Shift table and buckets of windows of similar length."""

    def __init__(self, patterns: list[bytes], ids: list[int], block: int):
        self.patterns, self.ids, self.b = patterns, ids, block
        self.m = min(map(len, patterns))
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        self.shift = np.full(1 << _TABLE_BITS, self.m - block + 1, np.int32)
        suffix = None
        for j in range(block, self.m + 1):  # the block that ends at byte j
            suffix = self.hashed(self._values(heads[:, j - block:j]))
            np.minimum.at(self.shift, suffix, self.m - j)
        order = np.argsort(suffix, kind="stable")
        self.members, keys = order, suffix[order]
        self.first = np.searchsorted(keys, np.arange(1 << _TABLE_BITS), side="left").astype(np.int32)
        self.count = np.bincount(keys, minlength=1 << _TABLE_BITS).astype(np.int32)
        width = min(8, self.m)
        self.width_mask = np.uint64((1 << 8 * width) - 1)
        self.starts = self._values(heads[:, :width])

    @staticmethod
    def _values(cols: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cols), np.uint64)
        for k in range(cols.shape[1]):
            out |= cols[:, k].astype(np.uint64) << np.uint64(8 * k)
        return out

    @staticmethod
    def hashed(values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, data: bytes, view: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(start, place in patterns) of every occurrence; ``view[i]`` is the
        little-endian word of the 8 bytes from ``i`` on."""
        if n < self.m:
            return []
        step = max(64, -(-(n - self.m + 1) // _CURSORS))
        at = np.arange(0, n - self.m + 1, step)
        stop = np.minimum(at + step, n - self.m + 1)
        mask, ahead = np.uint64((1 << 8 * self.b) - 1), self.m - self.b
        found_at, found_key = [], []
        while len(at):
            key = self.hashed(view[at + ahead] & mask)
            jump = self.shift[key]
            hit = np.flatnonzero(jump == 0)
            if len(hit):
                found_at.append(at[hit])
                found_key.append(key[hit])
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found_at:
            return []
        at, key = np.concatenate(found_at), np.concatenate(found_key)
        count = self.count[key]
        place = np.repeat(self.first[key] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        at, which = np.repeat(at, count), self.members[place]
        same = (view[at] & self.width_mask) == self.starts[which]
        patterns = self.patterns
        return [(s, p) for s, p in zip(at[same].tolist(), which[same].tolist(), strict=True)
                if data.startswith(patterns[p], s)]


class Searcher:
    """All windows of one block of the benchmark."""

    def __init__(self, patterns: list[bytes]):
        self.tiers = []
        below = math.inf
        for least, block in TIERS:
            ids = [i for i, p in enumerate(patterns) if least <= len(p) < below]
            below = least
            if ids:
                self.tiers.append(Tier([patterns[i] for i in ids], ids, block))

    def search(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(start in the joined texts, pattern)."""
        data = b"\n".join(texts)
        n = len(data)
        padded = data + b"\n" * 8
        view = np.ndarray((n + 1,), "<u8", padded, 0, (1,))
        return [(s, t.ids[p]) for t in self.tiers for s, p in t.search(data, view, n)]


def _kernel(searcher: Searcher, owners: list[list[int]], sizes: list[int]):
    """From texts to (number of words, runs of hit words, items found)."""

    def kernel(texts):
        words = [words_of(t) for t in texts]
        joined = [b" " + b" ".join(w) + b" " if w else b"" for w in words]
        begins = np.cumsum([0, *(len(j) + 1 for j in joined)])
        by_text: dict[int, list[tuple[int, int]]] = {}
        found = searcher.search(joined)
        for (s, p), k in zip(found, np.searchsorted(begins, [s for s, _ in found], side="right") - 1, strict=True):
            by_text.setdefault(int(k), []).append((s - int(begins[k]), p))
        runs, items = [[] for _ in texts], [[] for _ in texts]
        for k, hits in by_text.items():
            gaps = np.flatnonzero(np.frombuffer(joined[k], np.uint8) == 32)
            places = np.searchsorted(gaps, [s for s, _ in hits]).tolist()
            runs[k] = merge([(i, i + sizes[p]) for i, (_, p) in zip(places, hits, strict=True)])
            items[k] = sorted({o for _, p in hits for o in owners[p]})
        return [len(w) for w in words], runs, items

    return kernel


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
             item_text: str = "text", out: str = "contamination", size: int = WINDOW,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_words``, ``runs`` of hit words
    (half-open word ranges, merged) and ``items`` (ids as strings, sorted).

    Nothing is shuffled.  The benchmark is a query set: it is taken in blocks of
    about ``block_bytes`` of text (hashed by item), each broadcast and searched
    in a pass of its own over the same rows.

    Null texts have no words.  Items without words have no windows.  Rows of the
    benchmark with one id are one item; a null id is called ``null``.  An empty
    benchmark finds nothing.  If ``docs`` has a column ``out``, the new one gets
    underscores.
    """
    out = fresh(docs, out)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
                             F.col(item_text).cast("binary").alias("body")).where("body is not null")
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    n_blocks = max(1, -(-int(total) // block_bytes))
    df, inner = docs, []
    for b in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "body"), F.lit(n_blocks)) == b).collect()
        owner: dict[bytes, set[str]] = {}
        for r in rows:
            for w in windows_of(bytes(r["body"]), size):
                owner.setdefault(w, set()).add(r["id"])
        patterns = sorted(owner)
        sent = docs.sparkSession.sparkContext.broadcast((patterns, [sorted(owner[p]) for p in patterns]))

        def make(sent=sent):
            patterns, owners = sent.value
            return _kernel(Searcher(patterns), owners, [p.count(b" ") - 1 for p in patterns])

        inner.append([fresh(df, f"{out}_{c}{b}") for c in "nri"])
        df = map_text(df, text, list(zip(inner[b], ["long", "array<struct<begin:int,end:int>>", "array<string>"], strict=True)), make)
    runs, names = F.col(inner[0][1]), F.col(inner[0][2])
    if n_blocks > 1:
        runs = _merged(F.flatten(F.array(*[F.col(r) for _, r, _ in inner])))
        names = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(i) for *_, i in inner]))))
    return df.select(*docs.columns, F.struct(F.col(inner[0][0]).alias("n_words"), runs.alias("runs"),
                                             names.alias("items")).alias(out))


def _merged(runs):
    """Union of the ranges that several passes found."""
    return F.aggregate(
        F.array_sort(runs), F.array().cast("array<struct<begin:int,end:int>>"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["begin"] <= F.get(acc, F.size(acc) - 1)["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                     F.array(F.struct(F.get(acc, F.size(acc) - 1)["begin"].alias("begin"),
                                      F.greatest(F.get(acc, F.size(acc) - 1)["end"], r["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(r))))


def n_hit(out: str = "contamination"):
    """Number of words inside occurrences."""
    return F.aggregate(F.col(out)["runs"], F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` in which no window of the benchmark occurs."""
    out = fresh(docs, "contamination")
    found = annotate(docs, benchmark, text=text, out=out, **options)
    return found.where(F.size(F.col(out)["runs"]) == 0).select(*docs.columns)


def items_digest(items: list[str]) -> str:
    """What ``op1`` reports of a list of items."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
