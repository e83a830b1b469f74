"""Exploratory aggregates (the E family)."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.pvalues import correlation_two_sided
from tabulon.functions.scale import exact_quantiles, only_row


def _as_long(df: DataFrame, cols: list[str], dtype: str = "string") -> DataFrame:
    """(column, value) rows, generated map-side."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("value")) for c in cols]
    return df.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls")


def describe_dataset(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    types = dict(df.dtypes)
    n_by_type = {}
    for c in [*numeric, *categorical]:
        n_by_type[types[c]] = n_by_type.get(types[c], 0) + 1
    return df.agg(F.count("*").alias("n_instances")).select(
        "n_instances",
        F.lit(len(numeric) + len(categorical)).alias("n_features"),
        F.lit(len(numeric)).alias("n_num_features"),
        F.lit(len(categorical)).alias("n_cat_features"),
        F.lit(", ".join(f"{t}:{n}" for t, n in sorted(n_by_type.items()))).alias("dtypes"))


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Level counts of all columns in one shuffle; nulls are not levels."""
    return (_as_long(df, cols).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("freq")))


def level_shares(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    counts = value_counts(df, cols)
    totals = counts.groupBy("column").agg(F.sum("freq").alias("total"))
    return counts.join(totals, "column").select(
        "column", "value", "freq", F.round(F.col("freq") / F.col("total"), digits).alias("share"))


def distinct_levels(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every level with the number of levels of its column."""
    levels = _as_long(df, cols).where(F.col("value").isNotNull()).distinct()
    sizes = levels.groupBy("column").agg(F.count("*").alias("n_levels"))
    return levels.join(sizes, "column").select("column", "value", "n_levels")


def histogram(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """Equal-width bins over the common range of all columns."""
    ends = only_row(df.agg(F.least(*[F.min(c) for c in cols], F.lit(None).cast("double")).alias("lo"),
                           F.greatest(*[F.max(c) for c in cols], F.lit(None).cast("double")).alias("hi")))
    lo, hi = float(ends["lo"]), float(ends["hi"])
    width = (hi - lo) / bins or 1.0
    x = F.col("value")
    place = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    return (_as_long(df, cols, "double").where(x.isNotNull())
            .groupBy("column", place.alias("bin")).agg(F.count("*").alias("freq"))
            .select("column", "bin", (F.lit(lo) + F.col("bin") * width).alias("lower"), "freq"))


def box_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and number of outliers per column."""
    quart = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        q1, q2, q3 = (F.lit(q).cast("double") for q in quart[c])
        reach = 1.5 * (q3 - q1)
        inside = F.col(c).between(q1 - reach, q3 + reach)
        aggs.append(F.struct(
            F.lit(c).alias("column"), q1.alias("q1"), q2.alias("median"), q3.alias("q3"),
            F.min(F.when(inside, F.col(c))).cast("double").alias("low_whisker"),
            F.max(F.when(inside, F.col(c))).cast("double").alias("high_whisker"),
            F.count_if(~inside).alias("outliers")).alias(f"c{i}"))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(cols))])))


def _pair_matrix(df: DataFrame, cols: list[str], fn, name: str) -> DataFrame:
    pairs = list(combinations_with_replacement(cols, 2))
    aggs = [fn(a, b).alias(f"v{i}") for i, (a, b) in enumerate(pairs)]
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"v{i}").alias(name)))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    return _pair_matrix(df, cols, F.corr, "r")


def cov_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample covariance (n - 1)."""
    return _pair_matrix(df, cols, F.covar_samp, "cov")


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation and its two-sided p-value, one row."""
    one = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).agg(
        F.corr(a, b).alias("r"), F.count("*").alias("n"))
    row = only_row(one)
    p = None if row["r"] is None else correlation_two_sided(row["r"], row["n"])
    return one.withColumn("p_value", F.lit(p).cast("double"))


def validate_scores(gold: DataFrame, system: DataFrame, key: str, score: str,
                    low: float = 0.0, high: float = 5.0) -> DataFrame:
    """Rows whose score leaves the range or whose partner is missing."""
    joined = (gold.select(key, F.col(score).alias("gold"), F.lit(1).alias("_g"))
              .join(system.select(key, F.col(score).alias("system"), F.lit(1).alias("_s")),
                    key, "full_outer"))
    problem = (F.when(F.col("_g").isNull(), "missing gold")
               .when(F.col("_s").isNull(), "missing system")
               .when(F.col("system").isNull() | ~F.col("system").between(low, high), "system out of range")
               .when(F.col("gold").isNull() | ~F.col("gold").between(low, high), "gold out of range"))
    return joined.withColumn("problem", problem).where(F.col("problem").isNotNull()).drop("_g", "_s")


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    return corr_matrix(df, cols).where((F.col("a") < F.col("b")) & (F.abs("r") > threshold))


def drop_correlated(df: DataFrame, cols: list[str], threshold: float,
                    importance: dict[str, float]) -> DataFrame:
    """Of every pair above the threshold drop the less important column."""
    gone: set[str] = set()
    pairs = correlated_pairs(df, cols, threshold).collect()  # at most d(d-1)/2 rows
    for p in sorted(pairs, key=lambda p: (-abs(p["r"]), p["a"], p["b"])):
        if not {p["a"], p["b"]} & gone:
            gone.add(min((p["a"], p["b"]), key=lambda c: (importance.get(c, 0.0), c)))
    return df.drop(*gone)


def label_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))
