"""Text statistics (the N family) over ``(id, tokens array<string>)`` rows.

Counts explode tokens map-side and aggregate partially; n-grams come from the
token array of their own row, so no window or sort is involved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions import tokens as T
from tabulon.functions.scale import cut_lineage, only_row


def words(df: DataFrame, tokens: str = "tokens", by: Sequence[str] = ()) -> DataFrame:
    # the outer form keeps the optimizer from testing size(tokens) > 0 below the
    # tokenizing projection, which would run the tokenizer again
    return df.select(*by, F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull())


def text_stats(df: DataFrame, tokens: str = "tokens", by: Sequence[str] = ()) -> DataFrame:
    """Tokens, vocabulary and lexical diversity (tokens per type)."""
    types = words(df, tokens, by).groupBy(*by, "word").agg(F.count("*").alias("n"))
    return types.groupBy(*by).agg(F.sum("n").alias("tokens"), F.count("*").alias("types"),
                                  (F.sum("n") / F.count("*")).alias("diversity"))


def word_count(df: DataFrame, word: str, tokens: str = "tokens") -> DataFrame:
    hits = F.size(F.filter(tokens, lambda w: w == word))
    return df.agg(F.sum(hits).cast("bigint").alias("n"))


def freq_dist(df: DataFrame, tokens: str = "tokens", by: Sequence[str] = ()) -> DataFrame:
    return words(df, tokens, by).groupBy(*by, "word").agg(F.count("*").alias("n"))


def most_common(freq: DataFrame, n: int) -> DataFrame:
    return freq.orderBy(F.desc("n"), "word").limit(n)


def cumulative_freq(freq: DataFrame, n: int) -> DataFrame:
    w = Window.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, 0)  # n rows
    return most_common(freq, n).withColumn("cumulative", F.sum("n").over(w))


def hapaxes(freq: DataFrame) -> DataFrame:
    return freq.where("n = 1").select("word")


def long_words(freq: DataFrame, longer_than: int = 15) -> DataFrame:
    return freq.where(F.length("word") > longer_than).select("word")


def words_ending(freq: DataFrame, suffix: str) -> DataFrame:
    return freq.where(F.col("word").endswith(suffix)).select("word")


def length_dist(freq: DataFrame) -> DataFrame:
    """Counts and share per word length."""
    counts = freq.groupBy(F.length("word").alias("length")).agg(F.sum("n").alias("n"))
    total = only_row(freq.agg(F.sum("n").alias("t")))["t"]
    return counts.withColumn("share", F.col("n") / F.lit(total))


def concordance(df: DataFrame, word: str, width: int = 5, id_col: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """Every hit with up to ``width`` tokens on both sides."""
    t = F.col(tokens)
    lowered = F.transform(t, lambda w, i: F.struct(F.lower(w).alias("w"), (i + 1).alias("i")))
    hits = F.transform(F.filter(lowered, lambda s: s["w"] == word.lower()), lambda s: s["i"])
    found = df.select(id_col, t.alias("_t"), F.explode(hits).alias("pos"))
    start = F.greatest(F.col("pos") - width, F.lit(1))
    return found.select(
        id_col, (F.col("pos") - 1).alias("pos"),
        F.array_join(F.slice("_t", start, F.col("pos") - start), " ").alias("left"),
        F.element_at("_t", F.col("pos")).alias("word"),
        F.array_join(F.slice("_t", F.col("pos") + 1, width), " ").alias("right"))


def bigram_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return df.select(F.inline(T.bigrams(tokens))).groupBy("w1", "w2").agg(F.count("*").alias("n"))


def collocations(df: DataFrame, n: int = 20, tokens: str = "tokens", stopwords: list[str] | None = None,
                 min_count: int = 2, min_length: int = 3) -> DataFrame:
    """Frequent bigrams by log-likelihood ratio; stop words and short words
    are no partners. Marginals count bigram positions."""
    pairs = cut_lineage(bigram_counts(df, tokens))  # one row per distinct pair, read four times
    left = pairs.groupBy("w1").agg(F.sum("n").alias("a"))
    right = pairs.groupBy("w2").agg(F.sum("n").alias("b"))
    total = only_row(pairs.agg(F.sum("n").alias("t")))["t"] or 0
    stop = F.lit([w.lower() for w in (T.STOPWORDS if stopwords is None else stopwords)])
    ok = [(F.length(w) >= min_length) & ~F.array_contains(stop, F.lower(w)) for w in ("w1", "w2")]
    frame = pairs.where((F.col("n") >= min_count) & ok[0] & ok[1]).join(left, "w1").join(right, "w2")
    t = F.lit(float(total))
    n11, a, b = F.col("n").cast("double"), F.col("a").cast("double"), F.col("b").cast("double")

    def part(o, e):
        return F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))

    g2 = 2 * (part(n11, a * b / t) + part(a - n11, a * (t - b) / t) + part(b - n11, (t - a) * b / t)
              + part(t - a - b + n11, (t - a) * (t - b) / t))
    return frame.select("w1", "w2", "n", g2.alias("score")).orderBy(F.desc(F.round("score", 6)), "w1", "w2").limit(n)


def contexts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(left, word, right, n) from inner positions of every row."""
    t = F.col(tokens)
    inner = F.greatest(F.size(t) - 2, F.lit(0))
    zipped = F.arrays_zip(F.slice(t, 1, inner).alias("left"), F.slice(t, 2, inner).alias("word"),
                          F.slice(t, 3, inner).alias("right"))
    return df.select(F.inline(zipped)).groupBy("left", "word", "right").agg(F.count("*").alias("n"))


def similar_words(df: DataFrame, word: str, n: int = 20, tokens: str = "tokens") -> DataFrame:
    """Words seen in the contexts of ``word``, ranked by shared contexts. Only
    the contexts of one word are joined, never all pairs of a context."""
    ctx = contexts(df, tokens)
    mine = ctx.where(F.col("word") == word).select("left", "right")
    return (ctx.where(F.col("word") != word).join(mine, ["left", "right"], "left_semi")
            .groupBy("word").agg(F.count("*").alias("shared")).orderBy(F.desc("shared"), "word").limit(n))


def cond_freq_dist(df: DataFrame, cond: str, tokens: str = "tokens") -> DataFrame:
    return freq_dist(df, tokens, [cond])


def top_per_condition(cfd: DataFrame, cond: str, n: int = 1) -> DataFrame:
    w = Window.partitionBy(cond).orderBy(F.desc("n"), "word")
    # the rank limit is applied before the shuffle as well (window group limit)
    return cfd.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def conditions(cfd: DataFrame, cond: str) -> DataFrame:
    return cfd.groupBy(cond).agg(F.sum("n").alias("n"), F.count("*").alias("types"))


def language_model(df: DataFrame, lang: str, tokens: str = "tokens") -> DataFrame:
    """Word counts per language."""
    return freq_dist(df, tokens, [lang])


def language_id(df: DataFrame, model: DataFrame, lang: str, id_col: str, tokens: str = "tokens") -> DataFrame:
    """Language with the largest add-one smoothed unigram log-likelihood.

    ln((c + 1) / (N + V)) is 'ln(c + 1)' on seen words plus a per-language
    constant times the length, so only seen words are joined."""
    model = cut_lineage(model)
    vocabulary = only_row(model.select("word").distinct().agg(F.count("*").alias("v")))["v"]
    sizes = model.groupBy(lang).agg(F.sum("n").alias("size")).collect()  # one row per language
    counts = words(df, tokens, [id_col]).groupBy(id_col, "word").agg(F.count("*").alias("c"))
    seen = counts.join(model.withColumnRenamed(lang, "_lang"), "word")
    gain = seen.groupBy(id_col, "_lang").agg(F.sum(F.col("c") * F.log(F.col("n") + 1.0)).alias("gain"))
    table = F.array(*[F.struct(F.lit(r[lang]).alias("_lang"), F.lit(float(r["size"] + vocabulary)).alias("mass"))
                      for r in sorted(sizes, key=lambda r: r[lang])])
    base = df.select(id_col, F.size(tokens).alias("len"), F.inline(table))
    scored = base.join(gain, [id_col, "_lang"], "left").select(
        id_col, "_lang", (F.coalesce("gain", F.lit(0.0)) - F.col("len") * F.log("mass")).alias("score"))
    best = F.min(F.struct((-F.round("score", 6)).alias("s"), F.col("_lang").alias("l"))).alias("b")
    return scored.groupBy(id_col).agg(best).select(id_col, F.col("b.l").alias("predicted"), (-F.col("b.s")).alias("score"))
