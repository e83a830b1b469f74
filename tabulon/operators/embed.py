"""Text embeddings from word vectors and pair features (the V family)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions import vectors as V
from tabulon.functions.scale import only_row, with_ordinal
from tabulon.operators.explore import pearson
from tabulon.sources.corpus import BEGIN, END


def _marked(df: DataFrame, id_col: str, tokens: str) -> DataFrame:
    t = F.concat(F.array(F.lit(BEGIN)), F.col(tokens), F.array(F.lit(END)))
    return df.select(id_col, F.posexplode(t).alias("pos", "word"))


def _end_vector(vectors: DataFrame) -> list[float] | None:
    rows = vectors.where(F.col("word") == END).limit(1).collect()
    return list(rows[0]["vec"]) if rows else None


def _width(vectors: DataFrame) -> int:
    return only_row(vectors.select(F.size("vec").alias("d")).limit(1))["d"]


def embed_text(df: DataFrame, vectors: DataFrame, id_col: str, tokens: str = "tokens", pool: str = "max",
               name: str = "embedding") -> DataFrame:
    """Pooled vectors of in-vocabulary tokens with sentence marks; texts without
    any get the end mark's vector. One aggregate expression per dimension."""
    d = _width(vectors)
    # a word counts once per text with its weight, before it meets its vector
    words = _marked(df, id_col, tokens).groupBy(id_col, "word").agg(F.count("*").alias("w"))
    hit = words.join(vectors, "word")
    cells = []
    for i in range(d):
        x = F.get("vec", F.lit(i))
        cells.append(F.max(x) if pool == "max" else F.sum(x * F.col("w")) / F.sum("w"))
    pooled = hit.groupBy(id_col).agg(F.array(*cells).alias(name))
    end = _end_vector(vectors)
    out = df.join(pooled, id_col, "left")
    return out if end is None else out.withColumn(name, F.coalesce(name, F.lit([float(x) for x in end])))


def vocab_coverage(df: DataFrame, vectors: DataFrame, id_col: str, tokens: str = "tokens") -> DataFrame:
    """Kept and all tokens, sentence marks included."""
    words = _marked(df, id_col, tokens).groupBy("word").agg(F.count("*").alias("w"))
    known = vectors.select("word", F.lit(1).alias("known"))
    return words.join(known, "word", "left").agg(
        F.sum(F.when(F.col("known") == 1, F.col("w")).otherwise(0)).alias("kept"), F.sum("w").alias("total")).withColumn(
        "coverage", F.col("kept") / F.col("total"))


def token_importance(df: DataFrame, vectors: DataFrame, id_col: str, tokens: str = "tokens") -> DataFrame:
    """Share of dimensions in which a token holds the maximum (the first on a tie)."""
    d = _width(vectors)
    hit = _marked(df, id_col, tokens).join(vectors, "word")
    best = hit.groupBy(id_col).agg(F.array(*[F.min(F.struct(
        (-F.get("vec", F.lit(i))).alias("v"), "pos", "word")) for i in range(d)]).alias("b"))
    cells = best.select(id_col, F.explode("b").alias("c"))
    return cells.groupBy(id_col, F.col("c.pos").alias("pos"), F.col("c.word").alias("word")).agg(
        (F.count("*") / F.lit(d)).alias("share"))


def batch_encode(df: DataFrame, text: str, fn: Callable[[list[str]], np.ndarray], batch: int = 64,
                 name: str = "embedding") -> DataFrame:
    """Run a user encoder over fixed-size batches inside Arrow batches; texts of
    similar length go together, order is restored."""
    @F.pandas_udf("array<double>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            order = s.str.len().fillna(0).to_numpy().argsort(kind="stable")[::-1]
            out: list = [None] * len(s)
            for b in range(0, len(s), batch):
                idx = order[b:b + batch]
                for i, v in zip(idx, np.asarray(fn(s.iloc[idx].fillna("").tolist()), float)):
                    out[i] = v.tolist()
            yield pd.Series(out)
    return df.withColumn(name, encode(text))


def pair_embedding_score(df: DataFrame, a: str, b: str, name: str, kind: str = "cosine") -> DataFrame:
    fn = V.cosine_similarity if kind == "cosine" else V.angular_score
    return df.withColumn(name, fn(F.col(a), F.col(b)))


def pair_features(pairs: DataFrame, features: Sequence[DataFrame], key: str = "pair_id") -> DataFrame:
    """Join feature tables (one row per pair each) into the feature table."""
    out = pairs
    for f in features:
        out = out.join(f, key, "left")
    return out


def score_against_gold(system: DataFrame, gold: DataFrame, key: str, score: str, gold_score: str,
                       scale: float = 5.0, reverse_gold: bool = False) -> DataFrame:
    """Scores scaled to 0..``scale`` against the gold column; ``reverse_gold``
    pairs them with the gold list read backwards."""
    if reverse_gold:
        left = with_ordinal(system, [key], "_o")
        right = with_ordinal(gold.select(F.col(gold_score).alias("_gold"), F.col(key).alias("_k")), [F.desc("_k")], "_o")
        both = left.join(right, "_o")
    else:
        both = system.join(gold.select(key, F.col(gold_score).alias("_gold")), key)
    return pearson(both.withColumn("_sys", F.col(score) * scale), "_sys", "_gold")
