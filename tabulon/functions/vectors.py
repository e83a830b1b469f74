"""Distances and vector expressions over wide columns or array columns.

Every function takes either two lists of columns (the terms are unrolled, so
the expression stays inside whole-stage codegen) or two array columns (higher
order functions, for wide vectors).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = Column | str | Sequence


def _as_col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)


def _is_wide(v: Vector) -> bool:
    return isinstance(v, (list, tuple))


def literal_vector(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values])


def _total(a: Vector, b: Vector, term: Callable[[Column, Column], Column]) -> Column:
    if _is_wide(a) and _is_wide(b):
        terms = [term(_as_col(x), _as_col(y)) for x, y in zip(a, b, strict=True)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out
    a = F.array(*[_as_col(x) for x in a]) if _is_wide(a) else _as_col(a)
    b = F.array(*[_as_col(x) for x in b]) if _is_wide(b) else _as_col(b)
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Vector, b: Vector) -> Column:
    return _total(a, b, lambda x, y: x * y)


def squared_euclidean(a: Vector, b: Vector) -> Column:
    return _total(a, b, lambda x, y: (x - y) * (x - y))


def euclidean(a: Vector, b: Vector) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def manhattan(a: Vector, b: Vector) -> Column:
    return _total(a, b, lambda x, y: F.abs(x - y))


def minkowski(a: Vector, b: Vector, r: int = 2) -> Column:
    if r == 1:
        return manhattan(a, b)
    if r == 2:
        return euclidean(a, b)
    return F.pow(_total(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(r)))),
                 F.lit(1.0 / r))


def matching_distance(a: Sequence, b: Sequence) -> Column:
    """Number of unequal categorical cells."""
    out = F.lit(0)
    for x, y in zip(a, b, strict=True):
        out = out + F.when(_as_col(x).eqNullSafe(_as_col(y)), 0).otherwise(1)
    return out


def hamming_share(a: Sequence, b: Sequence) -> Column:
    return matching_distance(a, b) / F.lit(float(len(a)))


def mixed_distance(num_a, num_b, cat_a, cat_b, gamma: float = 0.8) -> Column:
    return matching_distance(cat_a, cat_b) + F.lit(float(gamma)) * euclidean(num_a, num_b)


def cosine_similarity(a: Vector, b: Vector) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_distance(a: Vector, b: Vector) -> Column:
    return 1 - cosine_similarity(a, b)


def angular_score(a: Vector, b: Vector) -> Column:
    """1 - acos of the clipped cosine."""
    return 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine_similarity(a, b))))


def jaccard_distance(a: Column, b: Column) -> Column:
    a, b = _as_col(a), _as_col(b)
    union = F.size(F.array_union(a, b))
    return (union - F.size(F.array_intersect(a, b))) / union


def jaccard_score(a: Column, b: Column, scale: float = 5.0) -> Column:
    """Set similarity on the 0..5 gold scale."""
    return (1 - jaccard_distance(a, b)) * F.lit(float(scale))


def overlap_score(a: Column, b: Column) -> Column:
    """2 x (occurrences in b of every word of a) / (words of a + words of b)."""
    a, b = _as_col(a), _as_col(b)
    hits = F.aggregate(a, F.lit(0), lambda acc, w: acc + F.size(F.filter(b, lambda x: x == w)))
    return F.lit(2.0) * hits / (F.size(a) + F.size(b))


def drop_leading(v: Column, size, skip: int = 1) -> Column:
    """The vector without its first ``skip`` cells."""
    return F.slice(_as_col(v), skip + 1, size)


def append_cells(v: Column, *cells) -> Column:
    """Extra cells (predictions, say) at the end of a feature vector."""
    return F.concat(_as_col(v), F.array(*[_as_col(c).cast("double") for c in cells]))


def project(v: Vector, axes: Sequence[Sequence[float]], mean: Sequence[float] | None = None) -> Column:
    """``v . W`` for literal axes given as rows, optionally centred."""
    shift = [0.0] * len(axes[0]) if mean is None else [float(m) for m in mean]
    if _is_wide(v):
        centred = [_as_col(x) - F.lit(m) if m else _as_col(x) for x, m in zip(v, shift, strict=True)]
        return F.array(*[dot(centred, [F.lit(float(w)) for w in axis]) for axis in axes])
    if mean is not None:
        v = F.zip_with(_as_col(v), literal_vector(shift), lambda x, m: x - m)
    return F.array(*[dot(v, literal_vector(axis)) for axis in axes])
