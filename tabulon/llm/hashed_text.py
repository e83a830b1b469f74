"""Hashed text features, bounded training samples and sparse linear fits."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices
from tabulon.llm.decontamination import words_of

#: Buckets are ``2**BITS``.
BITS = 18
#: Lengths of word beginnings (bytes) that are features of their own.
PREFIXES = (6, 5, 4)
#: Most labelled rows a model is fitted on; all other rows are only scored.
SAMPLE_ROWS = 8000
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))


def word_buckets(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Buckets of the distinct lower-cased words and of their first 4, 5 and 6
    bytes (marked), which catch stems with any ending."""
    words = set(words_of(text))
    for size in PREFIXES:
        words |= {w[:size] + b"\2" for w in words if len(w) > size and w[-1] != 2}
    return np.unique(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & ((1 << bits) - 1))


def _share(name: str, part: float, whole: float) -> bytes:
    """A token for the share in sixteenths."""
    return b"\0%s%d" % (name.encode(), math.floor(16 * part / whole) if whole else -1)


def style_buckets(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Buckets of words, of word shapes (``EDTH!!`` and ``Is!!`` give ``A!`` and
    ``Aa!``) and of how much is repeated, upper case, digits and punctuation."""
    raw = (text or b"").split()
    seen = set(raw)
    tokens = set(words_of(text))
    for shape in {w.translate(_SHAPE) for w in seen}:
        tokens.add(b"\1" + bytes(c for i, c in enumerate(shape[:32]) if not i or c != shape[i - 1]))
    kinds = np.bincount(np.frombuffer((text or b"").translate(_SHAPE), np.uint8), minlength=256)
    letters, total = int(kinds[65] + kinds[97]), int(kinds.sum() - kinds[32] - kinds[10])
    lines = (text or b"").split(b"\n")
    again = sum(a == b for a, b in zip(raw, raw[1:], strict=False))
    tokens |= {_share("distinct", len(seen), len(raw)), _share("again", again, len(raw)),
               _share("lines", len(set(lines)), len(lines)), _share("upper", int(kinds[65]), letters),
               _share("digits", int(kinds[48]), total), _share("marks", total - letters - int(kinds[48]), total),
               b"\0words%d" % len(raw).bit_length(), b"\0length%d" % (len(text or b"") // (len(raw) or 1))}
    return np.unique(np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) & ((1 << bits) - 1))


class Rows:
    """Sparse binary rows: ``cols[starts[i]:starts[i + 1]]`` are set in row i."""

    def __init__(self, lists: list[np.ndarray]):
        sizes = np.array([len(x) for x in lists], np.int64)
        self.n = len(lists)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.cols = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)

    def telling(self, target: np.ndarray, width: int) -> tuple[Rows, np.ndarray, np.ndarray]:
        """The same rows over renumbered buckets that have a scale; those buckets and scales."""
        scale = log_ratios(self, target, width)
        used = np.flatnonzero(scale)
        place = np.full(width, -1)
        place[used] = np.arange(len(used))
        keep = place[self.cols] >= 0
        out = Rows([])
        out.n, out.row, out.cols = self.n, self.row[keep], place[self.cols[keep]]
        out.starts = np.searchsorted(out.row, np.arange(self.n + 1))
        return out, used, scale[used]

    def take(self, rows: np.ndarray) -> Rows:
        return Rows([self.cols[self.starts[i]:self.starts[i + 1]] for i in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.cols], minlength=self.n)

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.cols, weights=g[self.row], minlength=width)


def log_ratios(x: Rows, target: np.ndarray, width: int, errors: float = 2.0) -> np.ndarray:
    """Scale of each bucket: how much oftener it stands in rows with a high
    target than with a low one (log of smoothed shares), less ``errors``
    standard errors.  Buckets that tell nothing get 0, so the many chance words
    of a long text do not add up."""
    high, low = np.maximum(target, 0), np.maximum(1 - target, 0)
    a, b = x.back(high, width) + 0.5, x.back(low, width) + 0.5
    ratio = np.log(a / (high.sum() + 1)) - np.log(b / (low.sum() + 1))
    return np.sign(ratio) * np.clip(np.abs(ratio) - errors * np.sqrt(1 / a + 1 / b), 0, 6)


def descend(gradient, start: np.ndarray, steps: int = 80, rate: float = 0.05) -> np.ndarray:
    """Adam with a falling rate over a full-batch gradient."""
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.98 * v + 0.02 * g * g
        w -= rate * (1 - 0.8 * t / steps) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.98 ** t)) + 1e-9)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, names: list[str], key: str, text: str, buckets,
                    rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and buckets of at most ``rows`` labelled documents, chosen by a
    hash of the key among all of them (so of every label and source).

    Only label rows of the sample are broadcast: at most ``rows`` of them.  Of
    several label rows of one document the largest value of each label counts;
    rows with a null label or key are not used.
    """
    held = labels.select(F.col(key).alias("k"), *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    held = held.groupBy("k").agg(*[F.max(c).alias(c) for c in names])
    n = held.count()
    part = 1.0 if n <= rows else (rows - 4 * math.sqrt(rows)) / n
    held = held.where(F.pmod(F.xxhash64(F.col("k"), F.lit("sample")), F.lit(1 << 30)) <= int(part * (1 << 30))).limit(rows)
    picked = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t")).join(
        F.broadcast(held), "k").select("k", "t", *names)

    def encode(batches):
        for batch in batches:
            for b in slices(batch, "t"):
                lists = [buckets(t).astype(np.int32) for t in b.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("k"), *[b.column(c) for c in names], pa.array(lists, pa.list_(pa.int32()))],
                    names=["k", *names, "at"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"k {kind}, " + ", ".join(f"`{c}` double" for c in names) + ", at array<int>"
    got = picked.mapInArrow(encode, schema).limit(rows).toArrow()
    order = np.argsort(np.array([str(k) for k in got.column("k").to_pylist()]), kind="stable")
    y = np.array([got.column(c).to_numpy() for c in names]).T.reshape(len(order), len(names))[order]
    lists = got.column("at").to_pylist()
    return y, [np.array(lists[i], np.int64) for i in order]
