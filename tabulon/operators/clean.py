"""Cleaning, scaling, encoding and binning (the C family).

``*_fit`` returns a state DataFrame (one row per column or per level), which
can be written and read back; ``*_transform`` takes a frame and that state and
inlines the bounded state as literals, so no join or extra shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.scale import bounded_rows, exact_quantiles, only_row, with_ordinal
from tabulon.operators.explore import _as_long, level_shares
from tabulon.operators.frame import FeatureSplit, split_features

MAX_STATE = 10_000  # columns or levels that may be inlined as literals


def _state(df: DataFrame) -> dict[str, dict]:
    return {r["column"]: r.asDict() for r in bounded_rows(df, MAX_STATE, "fitted state")}


def _per_column(df: DataFrame, cols: list[str], **aggs) -> DataFrame:
    """One row (column, statistic...) per column from one aggregate."""
    items, cells = [], []
    for i, c in enumerate(cols):
        fields = []
        for j, (name, fn) in enumerate(aggs.items()):
            items.append(fn(F.col(c).cast("double")).alias(f"s{i}_{j}"))
            fields.append(F.col(f"s{i}_{j}").alias(name))
        cells.append(F.struct(F.lit(c).alias("column"), *fields))
    return df.agg(*items).select(F.inline(F.array(*cells)))


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def moments_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    return _per_column(df, cols, mean=F.avg, std=F.stddev_pop)


def drop_outliers(df: DataFrame, cols: list[str], z: float = 3.0,
                  state: DataFrame | None = None) -> DataFrame:
    """Keep rows with |z-score| < z in all columns; a null cell passes."""
    st = _state(moments_fit(df, cols) if state is None else state)
    keep = F.lit(True)
    for c in cols:
        mean, std = st[c]["mean"], st[c]["std"]
        if mean is None or not std:
            continue
        keep = keep & F.coalesce(F.abs((F.col(c) - mean) / std) < z, F.lit(True))
    return df.where(keep)


def standard_transform(df: DataFrame, state: DataFrame) -> DataFrame:
    """(x - mean) / population sigma; sigma 0 divides by 1."""
    st = _state(state)
    return _replace(df, {c: (F.col(c) - F.lit(s["mean"])) / F.lit(s["std"] or 1.0)
                         for c, s in st.items()})


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return standard_transform(df, moments_fit(df, cols))


def minmax_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    return _per_column(df, cols, min=F.min, max=F.max)


def minmax_transform(df: DataFrame, state: DataFrame) -> DataFrame:
    """Scaled by the fitted range, which new data may leave; a constant column
    has range 1."""
    return _replace(df, {c: (F.col(c) - F.lit(s["min"])) / F.lit((s["max"] - s["min"]) or 1.0)
                         for c, s in _state(state).items() if s["min"] is not None})


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scaled by its own range; a constant column becomes null."""
    st = _state(minmax_fit(df, cols))
    out = {}
    for c, s in st.items():
        flat = s["min"] is None or s["min"] == s["max"]
        out[c] = (F.lit(None).cast("double") if flat
                  else (F.col(c) - F.lit(s["min"])) / F.lit(s["max"] - s["min"]))
    return _replace(df, out)


def impute_fit_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    return _per_column(df, cols, fill=F.avg)


def impute_fit_median(df: DataFrame, cols: list[str]) -> DataFrame:
    med = exact_quantiles(df, cols, [0.5])
    return df.sparkSession.createDataFrame([(c, med[c][0]) for c in cols], "column string, fill double")


def impute_transform(df: DataFrame, state: DataFrame, drop_empty: bool = False) -> DataFrame:
    st = _state(state)
    empty = [c for c, s in st.items() if s["fill"] is None]
    out = _replace(df, {c: F.coalesce(F.col(c).cast("double"), F.lit(s["fill"]))
                        for c, s in st.items() if s["fill"] is not None})
    return out.drop(*empty) if drop_empty else out


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    return impute_transform(df, impute_fit_mean(df, cols))


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median; a column without any value is dropped."""
    return impute_transform(df, impute_fit_median(df, cols), drop_empty=True)


def label_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, code): rank among the sorted distinct levels.

    Levels may be many, so ranks come from a distributed ordinal."""
    levels = _as_long(df, cols).where(F.col("value").isNotNull()).distinct()
    placed = with_ordinal(levels, ["column", "value"], "_ord")
    first = placed.groupBy("column").agg(F.min("_ord").alias("_first"))
    return placed.join(first, "column").select(
        "column", "value", (F.col("_ord") - F.col("_first")).alias("code"))


def label_transform(df: DataFrame, state: DataFrame, cols: list[str]) -> DataFrame:
    """Codes by join with the level table; AQE broadcasts it when small."""
    out = df
    for c in cols:
        codes = state.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias(f"{c}_code"))
        out = out.withColumn(c, F.col(c).cast("string")).join(codes, c, "left")
    return out


def label_inverse(df: DataFrame, state: DataFrame, col: str) -> DataFrame:
    levels = state.where(F.col("column") == col).select(
        F.col("code").alias(f"{col}_code"), F.col("value").alias(f"{col}_level"))
    return df.join(levels, f"{col}_code", "left")


def one_hot_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) per level, the state of the encoder."""
    return _as_long(df, cols).where(F.col("value").isNotNull()).distinct()


def _indicator_columns(state: DataFrame) -> dict[str, list[str]]:
    levels: dict[str, list[str]] = {}
    for r in bounded_rows(state, MAX_STATE, "one-hot levels"):
        levels.setdefault(r["column"], []).append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_transform(df: DataFrame, state: DataFrame, drop: bool = True) -> DataFrame:
    """One 0/1 column per fitted level; an unseen level gives all zeros."""
    levels = _indicator_columns(state)
    added = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
             for c in sorted(levels) for v in levels[c]]
    kept = [F.col(c) for c in df.columns if not (drop and c in levels)]
    return df.select(*kept, *added)


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    return one_hot_transform(df, one_hot_fit(df, cols))


get_dummies = one_hot


def binary_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns with exactly two levels."""
    levels = _as_long(df, cols).where(F.col("value").isNotNull()).distinct()
    return levels.groupBy("column").agg(F.count("*").alias("n_levels")).where("n_levels = 2")


def bin_equal_width(df: DataFrame, cols: list[str], n: int = 3) -> DataFrame:
    """Codes 0..n-1 of right-closed equal-width intervals; the lowest edge is
    stretched by 0.1 % of the range so that the minimum falls inside."""
    st = _state(minmax_fit(df, cols))
    out = {}
    for c, s in st.items():
        lo, hi = s["min"], s["max"]
        if lo is None:
            continue
        if lo == hi:  # a flat column gets a symmetric interval around its value
            pad = 0.001 * abs(lo) if lo else 0.001
            lo, hi = lo - pad, hi + pad
        edges = [lo + (hi - lo) * i / n for i in range(1, n)]
        code = F.when(F.col(c).isNull(), F.lit(None).cast("int"))
        for i, e in enumerate(edges):
            code = code.when(F.col(c) <= F.lit(e), F.lit(i))
        out[c] = code.otherwise(F.lit(n - 1))
    return _replace(df, out)


def bin_quantile(df: DataFrame, cols: list[str], n: int = 3) -> DataFrame:
    """Codes 0..n-1 of equal-frequency intervals, right-closed."""
    edges = exact_quantiles(df, cols, [i / n for i in range(1, n)])
    out = {}
    for c in cols:
        code = F.when(F.col(c).isNull(), F.lit(None).cast("int"))
        for i, e in enumerate(edges[c]):
            code = code.when(F.col(c) <= F.lit(e), F.lit(i))
        out[c] = code.otherwise(F.lit(n - 1))
    return _replace(df, out)


def merge_rare_levels(df: DataFrame, col: str, min_share: float, ordinal: bool = False) -> DataFrame:
    """Move levels below ``min_share`` into the nearest kept level in sort
    order (``ordinal``) or into the most common level."""
    rows = bounded_rows(level_shares(df, [col], digits=12), MAX_STATE, "levels")
    order = sorted(r["value"] for r in rows)
    share = {r["value"]: r["share"] for r in rows}
    kept = [v for v in order if share[v] >= min_share]
    if not kept:
        return df
    common = min(kept, key=lambda v: (-share[v], v))
    out = F.col(col).cast("string")
    for v in order:
        if share[v] >= min_share:
            continue
        if ordinal:
            target = min(kept, key=lambda k: (abs(order.index(k) - order.index(v)), -order.index(k)))
        else:
            target = common
        out = F.when(F.col(col).cast("string") == F.lit(v), F.lit(target)).otherwise(out)
    return df.withColumn(col, out)


def clean_mixed(df: DataFrame, categorical: list[str], response: str, level_map: dict[str, dict],
                z: float = 3.0) -> tuple[DataFrame, FeatureSplit]:
    """Split, drop outliers, scale, merge levels, one-hot."""
    split = split_features(df, categorical, response)
    out = drop_outliers(split.frame, split.numeric, z)
    out = standard_scale(out, split.numeric)
    for col, mapping in level_map.items():
        for old, new in mapping.items():
            out = out.withColumn(col, F.when(F.col(col) == F.lit(old), F.lit(new)).otherwise(F.col(col)))
    return one_hot(out, categorical), split


def clean_mean(df: DataFrame, categorical: list[str], response: str, dropped: list[str],
               z: float = 3.0) -> tuple[DataFrame, FeatureSplit]:
    """Split, drop columns, mean imputation, drop outliers, scale, one-hot."""
    split = split_features(df.drop(*dropped), categorical, response)
    out = impute_mean(split.frame, split.numeric)
    out = drop_outliers(out, split.numeric, z)
    out = standard_scale(out, split.numeric)
    return one_hot(out, categorical), split


def clean_median(df: DataFrame, categorical: list[str], response: str, dropped: list[str],
                 encoder: DataFrame | None = None) -> tuple[DataFrame, FeatureSplit, DataFrame]:
    """Split, drop columns, median imputation, own-range scaling, one-hot with
    an encoder that can be reused on the test part."""
    split = split_features(df.drop(*dropped), categorical, response)
    out = impute_median(split.frame, split.numeric)
    out = minmax_scale(out, [c for c in split.numeric if c in out.columns])
    encoder = one_hot_fit(out, categorical) if encoder is None else encoder
    return one_hot_transform(out, encoder), split, encoder
