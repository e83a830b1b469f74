"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over 7 bytes cuts a text wherever it hits a residue of the block
size, so cuts depend on nearby bytes alone and an edit changes few pieces.
Every piece becomes one letter.  A fingerprint is ``size:pieces:pieces`` with
the letters at the block size and at twice the size; fingerprints are compared
by edit distance where they have a size in common.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import fresh, map_text

#: Bytes of the rolling window; also the run of letters that comparable
#: signatures must share, which keeps chance alignments at 0.
ROLL = 7
#: Letters aimed at; a block size is the least of ``LEAST_BLOCK * 2**k`` that
#: makes no more pieces than this of a text on average.
LENGTH = 64
LEAST_BLOCK = 3
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def grow(self, n: int):
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, _U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


def _pieces(data: np.ndarray, cuts: np.ndarray, powers: Powers, sums: np.ndarray) -> str:
    """A letter for each piece; ``cuts`` are the last bytes of pieces."""
    _, down = powers.grow(len(data) + 1)
    ends = np.append(cuts + 1, len(data)) if not len(cuts) or cuts[-1] != len(data) - 1 else cuts + 1
    starts = np.concatenate([[0], ends[:-1]])
    h = (sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return _LETTERS[(h >> _U(58)).astype(np.intp)].tobytes().decode()


def fingerprint(body: bytes, powers: Powers) -> str:
    """Fingerprint of the bytes of a text; of no bytes: ``3::``."""
    n = len(body)
    size = LEAST_BLOCK
    while size * LENGTH < n:
        size *= 2
    if not n:
        return f"{size}::"
    data = np.frombuffer(body, np.uint8)
    up, _ = powers.grow(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:n], out=sums[1:])
    wide = data.astype(np.uint32) + np.uint32(1)
    rolling = wide * np.uint32(0x85EBCA6B)
    for k in range(1, min(ROLL, n)):
        rolling[k:] += wide[:-k] * np.uint32(0x85EBCA6B * pow(0xC2B2AE35, k, 1 << 32) % (1 << 32))
    rolling ^= rolling >> np.uint32(15)
    rolling *= np.uint32(0x2C1B3C6D)
    rolling ^= rolling >> np.uint32(13)
    while True:
        cuts = np.flatnonzero(rolling % np.uint32(size) == size - 1)
        # as few pieces tell little apart, a text with few cuts takes a smaller size
        if len(cuts) >= LENGTH // 2 or size == LEAST_BLOCK:
            break
        size //= 2
    twice = cuts[rolling[cuts] % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_pieces(data, cuts, powers, sums)}:{_pieces(data, twice, powers, sums)}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and substitutions, by bit-parallel columns."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        eq = where.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        h_up, h_down = down | ~(diag | up) & full, up & diag
        score += bool(h_up & last) - bool(h_down & last)
        h_up = (h_up << 1 | 1) & full
        h_down = h_down << 1 & full
        up, down = h_down | ~(diag | h_up) & full, h_up & diag
    return score


def _alike(a: str, b: str) -> float:
    """1 for equal letters; 0 for long signatures without a common run."""
    if a == b:
        return 1.0
    if min(len(a), len(b)) >= ROLL:
        runs = {a[i:i + ROLL] for i in range(len(a) - ROLL + 1)}
        if not any(b[i:i + ROLL] in runs for i in range(len(b) - ROLL + 1)):
            return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; equal fingerprints 1, incompatible block sizes 0."""
    if x == y:
        return 1.0
    (s, a1, a2), (t, b1, b2) = x.split(":"), y.split(":")
    s, t = int(s), int(t)
    if s == t:
        return max(_alike(a1, b1), _alike(a2, b2) if a2 or b2 else 0.0)
    if s == 2 * t:
        return _alike(a1, b2)
    if t == 2 * s:
        return _alike(a2, b1)
    return 0.0


def add_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of every whole text; null counts as empty.  Equal
    texts have equal fingerprints; an empty table gives an empty one.  If ``docs``
    has a column ``out``, the new one gets underscores."""
    out = fresh(docs, out)

    def make():
        powers = Powers()
        return lambda texts: ([fingerprint(t or b"", powers) for t in texts],)

    return map_text(docs, text, [(out, "string")], make)


#: Rows of a bucket of neighbouring keys, on average, and most buckets there are
#: (so many key values reach the driver; more rows make larger buckets, which
#: tasks sort externally and read as a stream).
BUCKET_ROWS = 4000
MAX_BUCKETS = 20_000


def _cuts(keys: DataFrame, rows: int, most: int) -> list:
    """Existing keys, the largest first, that split the keys into buckets."""
    n, top = keys.agg(F.count("k"), F.max("k")).first()
    parts = min(most, n // rows)
    cuts = {top} if n else set()
    if parts > 1:
        # every s-th key in a hash order, about 16 for each bucket; the choice moves borders, never results
        s = max(1, n // (16 * parts))
        drawn = sorted(r[0] for r in keys.where("k is not null").where(F.pmod(F.xxhash64("k"), F.lit(s)) == 0).distinct().collect())
        cuts.update(drawn[::16])
    return sorted(cuts, reverse=True)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS,
                      max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """Fingerprint every text, its edited form and the next document.

    Documents stand in descending order of ``key`` (nulls last; rows of one key
    by text, null as empty); after the last comes the first.  The edited text has its last
    ``n_chars // 2`` code points replaced by the first as many of the next
    document.  Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Keys are cut into buckets at existing keys, so the head of a bucket is known
    by its key alone and travels to the bucket before it as a guard.  Whole
    texts are shuffled once.  Rows that share one key share a bucket.
    """
    base = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    cuts = _cuts(base.select("k"), bucket_rows, max_buckets)
    sent = docs.sparkSession.sparkContext.broadcast(np.array(cuts[::-1]))
    m = len(cuts)

    def place(batches):
        ascending = sent.value
        for batch in batches:
            k = batch.column("k")
            known = np.asarray(k.is_valid())
            values = k.fill_null(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(ascending, values, side="left")
            bucket = np.where(known, m - 1 - at, max(m - 1, 0)).astype(np.int32)
            head = np.flatnonzero(known & (ascending[np.minimum(at, m - 1)] == values)) if m else np.zeros(0, np.intp)
            rows = np.concatenate([np.arange(len(values)), head])
            bucket = np.concatenate([bucket, (bucket[head] - 1) % max(m, 1)]).astype(np.int32)
            guard = (np.arange(len(rows)) >= len(values)).astype(np.int8)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(guard), *taken.columns],
                                             names=["bucket", "guard", "k", "t"])

    kind = base.schema["k"].dataType.simpleString()
    placed = base.mapInArrow(place, f"bucket int, guard tinyint, k {kind}, t string")
    ordered = add_fingerprint(placed.repartition("bucket").sortWithinPartitions(
        "bucket", "guard", F.desc_nulls_last("k"), "t"), text="t", out="f")
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def pair(batches):
        powers = Powers()
        done: list[tuple] = []
        first = last = None  # of the bucket now open

        def finish(row, after):
            t, nxt = row[3], after[3]
            half = len(t) // 2
            body = (t[:len(t) - half] + nxt[:half]).encode()
            f = fingerprint(body, powers)
            done.append((row[2], len(t), hashlib.sha256(body).hexdigest(), row[4], f,
                         likeness(row[4], f), likeness(row[4], after[4])))

        def flush():
            rows = list(zip(*done, strict=True)) if done else [[] for _ in range(7)]
            done.clear()
            kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            kinds[0] = key_type
            return pa.RecordBatch.from_arrays([pa.array(v, c) for v, c in zip(rows, kinds, strict=True)],
                                              names=[key, *names])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field("k").type
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if last is not None and row[0] != last[0]:  # only a bucket that stands alone lacks a guard
                        if not last[1]:
                            finish(last, first)
                        last = None
                    if last is None:
                        first = row
                    elif not last[1]:
                        finish(last, row)
                    last = row
            if done:
                yield flush()
        if last is not None and not last[1]:
            finish(last, first)
            yield flush()

    return ordered.mapInArrow(pair, f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
