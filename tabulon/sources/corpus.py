"""Corpora and word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions.scale import with_ordinal

BEGIN, END = "<s>", "</s>"


def category_words(df: DataFrame, category: str, text: str, id_col: str) -> DataFrame:
    """(category, sent_id, pos, word): sentences numbered inside their text."""
    sents = df.select(F.col(category).alias("category"), id_col, F.posexplode(T.sentence_split(text)).alias("sent", "_s"))
    return sents.select("category", id_col, F.col("sent").alias("sent_id"),
                        F.posexplode(T.word_tokenize("_s")).alias("pos", "word"))


def tagged_corpus(df: DataFrame, category: str, seq: str, order: list[str], word: str, tag: str) -> DataFrame:
    """(category, sent_id, pos, token, tag) from rows of one token each."""
    placed = with_ordinal(df, [seq, *order], "_o")
    first = placed.groupBy(seq).agg(F.min("_o").alias("_f"))
    return placed.join(first, seq).select(
        F.col(category).alias("category"), F.col(seq).alias("sent_id"), (F.col("_o") - F.col("_f")).alias("pos"),
        F.col(word).alias("token"), F.col(tag).alias("tag"))


def vocabulary(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """Distinct tokens plus the two sentence marks."""
    marks = tokens.sparkSession.createDataFrame([(BEGIN,), (END,)], "word string")
    words = tokens.select(F.explode_outer(col).alias("word")).where(F.col("word").isNotNull())
    return words.unionByName(marks).distinct()


def _parse(lines: DataFrame) -> DataFrame:
    part = F.split("value", " ", 2)
    return lines.select(F.get(part, F.lit(0)).alias("word"), F.transform(
        F.filter(F.split(F.get(part, F.lit(1)), r"\s+"), lambda x: x != ""), lambda x: x.cast("double")).alias("vec"),
        *[c for c in lines.columns if c != "value"])


def read_word_vectors(spark: SparkSession, path: str, vocab: DataFrame | None = None,
                      first_k: int | None = None) -> DataFrame:
    """(word, vec): words of ``vocab`` only, or the first k + 1 lines plus the
    sentence marks (the reader counts from zero up to and including k)."""
    lines = spark.read.text(path)
    if first_k is not None:
        from tabulon.sources.tables import line_numbers
        rows = _parse(line_numbers(lines, "line"))
        return rows.where((F.col("line") <= first_k) | F.col("word").isin(BEGIN, END)).drop("line")
    # the vocabulary filter runs on the bare word, before vectors are parsed
    if vocab is not None:
        keyed = lines.withColumn("word", F.substring_index("value", " ", 1))
        lines = keyed.join(vocab, "word", "left_semi").select("value")
    return _parse(lines)


def extend_vocab(vectors: DataFrame, source: DataFrame, tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """Add vectors of words not present yet."""
    new = vocabulary(tokens, col).join(vectors.select("word"), "word", "left_anti")
    return vectors.unionByName(source.join(new, "word", "left_semi"))
