"""Toxicity by a classifier chain.

Categories stand in a fixed order.  The model of a category sees hashed words
and the probabilities of the categories before it.  While training, those
probabilities are out-of-fold predictions, so a later model learns from the
errors an earlier one makes on texts it has not seen; when scoring, they come
from the models fitted on the whole sample.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tabulon.llm.common import fresh, map_text
from tabulon.llm.hashed_text import BITS, SAMPLE_ROWS, Rows, descend, labelled_sample, word_buckets

#: Folds of the out-of-fold predictions.
FOLDS = 3
#: From this probability of the last category on a document is rejected.
THRESHOLD = 0.5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Link:
    """Logistic model of one category: weights of buckets, of the earlier
    probabilities, and a constant."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, bias: float):
        self.weights, self.chain, self.bias = weights, chain, bias

    def probability(self, sums: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(sums + earlier @ self.chain + self.bias)


def fit_link(x: Rows, earlier: np.ndarray, y: np.ndarray, width: int, ridge: float = 0.02) -> Link:
    """Weights live on buckets scaled by their log ratios.  Without both classes
    the model is a constant: the share of positives, 0 for an empty sample."""
    k = earlier.shape[1]
    if not len(y) or y.min() == y.max():
        return Link(np.zeros(width, np.float32), np.zeros(k), 40.0 if len(y) and y.min() > 0 else -40.0)
    small, used, r = x.telling(y, width)
    centred = earlier - 0.5

    def gradient(w):
        z = small.dot(w[:len(used)] * r) + centred @ w[len(used):-1] + w[-1]
        g = (_sigmoid(z) - y) / len(y)
        out = np.concatenate([small.back(g, len(used)) * r, centred.T @ g, [g.sum()]])
        out[:-1] += ridge / len(y) * w[:-1]
        return out

    start = np.zeros(len(used) + k + 1)
    start[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    w = descend(gradient, start)
    weights = np.zeros(width, np.float32)
    weights[used] = w[:len(used)] * r
    return Link(weights, w[len(used):-1], float(w[-1] - 0.5 * w[len(used):-1].sum()))


def fit_chain(y: np.ndarray, lists: list[np.ndarray], bits: int = BITS, folds: int = FOLDS) -> list[Link]:
    """A link for each column of ``y``."""
    width, x = 1 << bits, Rows(lists)
    earlier, links = np.zeros((len(lists), 0)), []
    fold = np.arange(len(lists)) % folds
    for c in range(y.shape[1]):
        links.append(fit_link(x, earlier, y[:, c], width))
        if c + 1 < y.shape[1]:
            seen = np.zeros(len(lists))
            for f in range(folds):
                inside, outside = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                link = fit_link(x.take(outside), earlier[outside], y[outside, c], width)
                seen[inside] = link.probability(x.take(inside).dot(link.weights), earlier[inside])
            earlier = np.column_stack([earlier, seen])
    return links


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text",
        rows: int = SAMPLE_ROWS, bits: int = BITS, folds: int = FOLDS) -> list[Link]:
    """Chain over ``categories`` (0/1 columns of ``labels``) from a sample of at
    most ``rows`` labelled documents.  Without labelled documents every
    probability is 0."""
    y, lists = labelled_sample(docs, labels, categories, key, text, lambda t: word_buckets(t, bits), rows)
    return fit_chain(y, lists, bits, folds)


def score(docs: DataFrame, chain: list[Link], out: list[str], text: str = "text", bits: int = BITS) -> DataFrame:
    """Append a probability column for each link.  A null or empty text has no
    words and gets the constants of the models; texts of any length count with all
    their words.  Repeated rows get equal answers, an empty table gives an empty
    one.  Where ``docs`` has a column of a new one's name, the new one gets
    underscores."""
    out = [fresh(docs, c) for c in out]
    sent = docs.sparkSession.sparkContext.broadcast([(k.weights, k.chain, k.bias) for k in chain])

    def make():
        links = [Link(*k) for k in sent.value]

        def kernel(texts):
            sums = np.zeros((len(texts), len(links)))
            for i, t in enumerate(texts):
                at = word_buckets(t, bits)
                for c, link in enumerate(links):
                    sums[i, c] = link.weights[at].sum(dtype=np.float64)
            p = np.zeros((len(texts), 0))
            for c, link in enumerate(links):
                p = np.column_stack([p, link.probability(sums[:, c], p)])
            return [p[:, c].tolist() for c in range(len(links))]

        return kernel

    return map_text(docs, text, [(c, "double") for c in out], make)
