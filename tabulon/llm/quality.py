"""Quality of documents by ordinal cumulative-link regression.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector over hashed
text for all grades and ordered thresholds between them.  A text gets its
expected grade and the probability of at least a wanted grade.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tabulon.llm.common import fresh, map_text
from tabulon.llm.hashed_text import BITS, SAMPLE_ROWS, Rows, descend, labelled_sample, style_buckets

#: A document is selected from this tail probability on.
THRESHOLD = 0.5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights, thresholds (ascending) and the grades they separate."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, grades: list[float]):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def above(self, sums: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` for each text and each threshold."""
        return _sigmoid(sums[:, None] - self.thresholds[None, :])


def _cuts(t: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free numbers: first, then logs of the gaps."""
    return t[0] + np.concatenate([[0.0], np.cumsum(np.exp(np.clip(t[1:], -8, 4)))])


def fit_rows(grade: np.ndarray, lists: list[np.ndarray], bits: int = BITS, ridge: float = 0.02) -> Model:
    """Maximum likelihood with a ridge.  Grades are the distinct values met; with
    one grade or none there is no threshold and every text gets that grade (0)."""
    width = 1 << bits
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return Model(np.zeros(width, np.float32), np.zeros(0), grades or [0.0])
    level = np.searchsorted(grades, grade)
    k, n = len(grades) - 1, len(grade)
    x, used, r = Rows(lists).telling(level / k, width)

    def gradient(p):
        t = p[len(used):]
        cuts = _cuts(t)
        s = x.dot(p[:len(used)] * r)
        # high and low: sigmoid at the upper and lower threshold of each row's grade
        high = np.where(level < k, _sigmoid(cuts[np.minimum(level, k - 1)] - s), 1.0)
        low = np.where(level > 0, _sigmoid(cuts[np.maximum(level - 1, 0)] - s), 0.0)
        inside = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / inside / n, low * (1 - low) / inside / n
        g_s = d_high - d_low
        g_cut = -np.bincount(level[level < k], weights=d_high[level < k], minlength=k)
        g_cut += np.bincount(level[level > 0] - 1, weights=d_low[level > 0], minlength=k)
        tails = np.cumsum(g_cut[::-1])[::-1]
        g_t = np.concatenate([[tails[0]], tails[1:] * np.exp(np.clip(t[1:], -8, 4))])
        return np.concatenate([x.back(g_s, len(used)) * r + ridge / n * p[:len(used)], g_t])

    below = np.array([(level <= j).mean() for j in range(k)])
    cuts = np.log((below + 1e-3) / (1 - below + 1e-3))
    start = np.concatenate([np.zeros(len(used)), [cuts[0]], np.log(np.maximum(np.diff(cuts), 1e-2))])
    p = descend(gradient, start)
    weights = np.zeros(width, np.float32)
    weights[used] = p[:len(used)] * r
    return Model(weights, _cuts(p[len(used):]), grades)


def fit(docs: DataFrame, labels: DataFrame, grade: str, key: str = "doc_id", text: str = "text",
        rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Model of the ``grade`` column of ``labels`` from a sample of at most
    ``rows`` labelled documents."""
    y, lists = labelled_sample(docs, labels, [grade], key, text, lambda t: style_buckets(t, bits), rows)
    return fit_rows(y[:, 0], lists, bits)


def score(docs: DataFrame, model: Model, least: float, text: str = "text", bits: int = BITS,
          expected: str = "expected_grade", tail: str = "p_tail") -> DataFrame:
    """Append the expected grade and the probability of a grade of ``least`` or
    more.  Null and empty texts are scored by the tokens of an empty text, texts of
    any length by all their tokens.  Repeated rows get equal answers, an empty
    table gives an empty one.  Where ``docs`` has a column of a new one's name,
    the new one gets underscores."""
    expected, tail = fresh(docs, expected), fresh(docs, tail)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.grades))

    def make():
        m = Model(*sent.value)
        steps = np.diff(m.grades)
        at = int(np.searchsorted(m.grades, least))

        def kernel(texts):
            sums = np.array([m.weights[style_buckets(t, bits)].sum(dtype=np.float64) for t in texts]).reshape(len(texts))
            above = m.above(sums)
            mean = m.grades[0] + above @ steps
            tails = above[:, at - 1] if 0 < at <= len(steps) else np.full(len(texts), float(at == 0))
            return mean.tolist(), tails.tolist()

        return kernel

    return map_text(docs, text, [(expected, "double"), (tail, "double")], make)
