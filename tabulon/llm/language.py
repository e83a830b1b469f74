"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting runs over every training text: tasks add up a count matrix of
languages by buckets and emit its non-zero cells once, Spark sums them by
language and bucket.  The log-probability matrix (``max_languages`` x
``2**bits`` floats at most) is broadcast; texts are scored in batches by
gathering and adding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.scale import bounded_rows
from tabulon.llm.common import fresh, map_text, slices

#: Buckets are ``2**BITS``.
BITS = 14
#: Lengths of the n-grams.
ORDERS = (1, 2, 3)
#: Most languages a model may have: proves the size of the broadcast matrix.
MAX_LANGUAGES = 512
UNDETERMINED = "und"


def hashed_ngrams(text: str, orders=ORDERS, bits: int = BITS) -> list[np.ndarray]:
    """Buckets of the n-grams of the lower-cased text, a space before and after;
    one array for each order."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, acc = [], None
    for n in range(1, max(orders) + 1):
        if n > len(points):
            break
        acc = points if n == 1 else acc[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:]
        if n in orders:
            spread = (acc + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            out.append(((spread ^ (spread >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                        >> np.uint64(64 - bits)).astype(np.intp))
    return out


class Model:
    """Languages and their log-probabilities by bucket."""

    def __init__(self, languages: list[str], priors: np.ndarray, table: np.ndarray, orders, bits: int):
        self.languages, self.priors, self.table, self.orders, self.bits = languages, priors, table, orders, bits

    def scores(self, text: str) -> np.ndarray:
        total = self.priors.astype(np.float64).copy()
        for places in hashed_ngrams(text, self.orders, self.bits):
            counts = np.bincount(places, minlength=0)
            if len(places) > 4096:  # many n-grams: one look-up for each bucket met
                met = np.flatnonzero(counts)
                total += counts[met] @ self.table[met]
            else:
                total += self.table[places].sum(axis=0, dtype=np.float64)
        return total


def fit(train: DataFrame, text: str = "text", lang: str = "lang", orders=ORDERS, bits: int = BITS,
        smoothing: float = 0.5, max_languages: int = MAX_LANGUAGES) -> Model:
    """Model of all rows with a text and a language.  Ties in scores go to the
    language that sorts first.  Raises ValueError beyond ``max_languages``.
    Without training rows the model has no languages and predicts ``und``."""
    rows = train.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    names = sorted(r[0] for r in bounded_rows(rows.select("lang").distinct(), max_languages, "languages"))
    index = {n: i for i, n in enumerate(names)}

    def count(batches):
        cells = np.zeros((len(index), 1 << bits), np.int64)
        docs = np.zeros(len(index), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for t, g in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    k = index[g]
                    docs[k] += 1
                    for places in hashed_ngrams(t, orders, bits):
                        cells[k] += np.bincount(places, minlength=1 << bits)
        k, b = np.nonzero(cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([k, np.arange(len(docs))]).astype(np.int32)),
             pa.array(np.concatenate([b, np.full(len(docs), -1)]).astype(np.int32)),
             pa.array(np.concatenate([cells[k, b], docs]).astype(np.int64))], names=["k", "b", "n"])

    table = np.zeros((1 << bits, len(names)), np.float64)
    priors = np.zeros(len(names))
    if names:
        # one row a language, so at most max_languages x 2**bits numbers reach the driver
        sums = rows.mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n"))
        packed = sums.toArrow()
        k, b, n = (packed.column(c).to_numpy() for c in ("k", "b", "n"))
        cell = b >= 0
        table[b[cell], k[cell]] = n[cell]
        priors[k[~cell]] = n[~cell]
    table = np.log((table + smoothing) / (table.sum(axis=0) + smoothing * (1 << bits))).astype(np.float32)
    return Model(names, np.log(np.maximum(priors, 1) / max(priors.sum(), 1)), table, orders, bits)


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """Append the most probable language and its posterior probability.

    ``und`` with score 0 if the text is null or has no letter (empty texts
    too), or the model knows no language.  Texts of any length are read whole,
    equal texts get equal answers, an empty table gives an empty one.  Where
    ``docs`` has a column of a new one's name, the new one gets underscores."""
    pred, score = fresh(docs, pred), fresh(docs, score)
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.priors, model.table, model.orders, model.bits))

    def make():
        m = Model(*sent.value)

        def kernel(texts):
            langs, values = [], []
            for t in texts:
                s = t.decode("utf-8", "replace") if t else ""
                if not m.languages or not any(map(str.isalpha, s)):
                    langs.append(UNDETERMINED)
                    values.append(0.0)
                    continue
                total = m.scores(s)
                best = int(np.argmax(total))
                langs.append(m.languages[best])
                values.append(float(1 / np.exp(total - total[best]).sum()))
            return langs, values

        return kernel

    return map_text(docs, text, [(pred, "string"), (score, "double")], make)
