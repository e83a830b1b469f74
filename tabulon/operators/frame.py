"""Projection, filter, reshape and split (the P family)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.scale import first_rows, hash_order, only_row, with_ordinal


@dataclass(frozen=True)
class FeatureSplit:
    """A typed frame plus the names of its column groups."""

    frame: DataFrame
    numeric: list[str]
    categorical: list[str]
    response: str
    response_levels: list[str] | None  # set when the response was label-encoded
    metadata: dict = field(default_factory=dict)


def _all_integers(df: DataFrame, cols: list[str]) -> dict[str, bool]:
    """Which string columns hold nothing but integers (one aggregate)."""
    if not cols:
        return {}
    row = only_row(df.agg(*[
        F.coalesce(F.bool_and(F.col(c).isNull() | F.expr(f"try_cast(`{c}` AS bigint)").isNotNull()),
                   F.lit(True)).alias(c) for c in cols]))
    return row.asDict()


def split_features(df: DataFrame, categorical: list[str] | None = None,
                   response: str = "class", max_classes: int = 10_000) -> FeatureSplit:
    """Numeric to double; categorical and response to bigint when every cell
    allows it; otherwise the response becomes its rank among sorted levels."""
    categorical = list(categorical or [])
    numeric = [c for c in df.columns if c not in categorical and c != response]
    text = df.select(*[F.col(c).cast("string").alias(c) for c in [*categorical, response]])
    as_int = _all_integers(text, [*categorical, response])
    # the categorical block is converted only as a whole
    cat_type = "bigint" if categorical and all(as_int[c] for c in categorical) else "string"
    levels = None
    if as_int[response]:
        target = F.col(response).cast("bigint")
    else:
        found = (text.select(response).where(F.col(response).isNotNull()).distinct()
                 .orderBy(response).limit(max_classes + 1).collect())
        if len(found) > max_classes:
            raise ValueError(f"response {response!r} has more than {max_classes} classes")
        levels = [r[0] for r in found]
        target = (F.array_position(F.lit(levels), F.col(response).cast("string")) - 1).cast("bigint")
    frame = df.select(
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[F.col(c).cast("string").cast(cat_type).alias(c) for c in categorical],
        target.alias(response))
    meta = {"n_num_features": len(numeric), "n_cat_features": len(categorical),
            "n_features": len(numeric) + len(categorical), "dtypes": dict(frame.dtypes)}
    return FeatureSplit(frame, numeric, categorical, response, levels, meta)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def keep_columns(df: DataFrame, excluded: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in excluded])


def filter_rows(df: DataFrame, mask: Column) -> DataFrame:
    """One mask over features and label together."""
    return df.where(mask)


def replace_level(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    out = F.col(col)
    for old, new in mapping.items():
        out = F.when(F.col(col) == F.lit(old), F.lit(new)).otherwise(out)
    return df.withColumn(col, out)


def join_features(left: DataFrame, right: DataFrame, on: str | list[str] = "row_id") -> DataFrame:
    """Horizontal concatenation by explicit row key."""
    return left.join(right, on)


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sort_by_time(df: DataFrame, ts: str, fmt: str | None = None) -> DataFrame:
    parsed = F.to_timestamp(ts, fmt) if fmt else F.col(ts)
    return df.withColumn(ts, parsed).orderBy(ts)


def time_slice(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Both ends inclusive; a missing end is open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return df


def cast_all(df: DataFrame, dtype: str, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    return df.select(*[F.col(c).cast(dtype).alias(c) if c in cols else F.col(c) for c in df.columns])


def to_long(df: DataFrame, ids: list[str], cols: list[str], name: str = "column",
            value: str = "value") -> DataFrame:
    return df.unpivot(ids, cols, name, value)


def to_wide(df: DataFrame, ids: list[str], cols: list[str], name: str = "column",
            value: str = "value") -> DataFrame:
    return df.groupBy(*ids).pivot(name, cols).agg(F.first(value))


def _leading(df: DataFrame, order: list, ranks: list[int], total: int) -> tuple[DataFrame, list]:
    """Conditions for the first ``ranks`` rows; rows that are equal in ``order``
    are told apart by their place in a sorted copy, and only they need one."""
    found = first_rows(df, order, ranks, total)
    if found is not None:
        return df, found
    placed = with_ordinal(df, order, "_ord")
    return placed, [F.col("_ord") < r for r in ranks]


def prefix_split(df: DataFrame, order: list, share: float = 0.9) -> DataFrame:
    """First ``share`` of the ordered rows are train, the rest test."""
    n = df.count()
    rows, (first,) = _leading(df, order, [int(n * share)], n)
    return rows.select(*df.columns, F.when(first, "train").otherwise("test").alias("split"))


def take_first(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def random_split(df: DataFrame, key: list[str], test_share: float = 0.2, seed: int = 12) -> DataFrame:
    """Exact-size reproducible split: rank of a seeded hash of the row key."""
    n = df.count()
    n_test = -(-n * int(round(test_share * 1000)) // 1000)
    rows, (first,) = _leading(df, [hash_order(*key, F.lit(seed)), *key], [n_test], n)
    return rows.select(*df.columns, F.when(first, "test").otherwise("train").alias("split"))


def contiguous_folds(df: DataFrame, order: list, k: int, name: str = "fold") -> DataFrame:
    """Unshuffled k folds; the first n mod k folds hold one row more."""
    n = df.count()
    size, extra = divmod(n, k)
    ends = [f * size + min(f, extra) for f in range(1, k)]
    rows, before = _leading(df, order, ends, n)
    fold = F.lit(0)
    for b in before:
        fold = fold + F.when(b, 0).otherwise(1)
    return rows.select(*[c for c in df.columns if c != name], fold.cast("int").alias(name))
