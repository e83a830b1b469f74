"""Helpers that keep global operations distributed.

A total order, an exact quantile or a fitted statistic is easy to get wrong at
scale: an unpartitioned window or an exact ``percentile`` moves every row
through one task.  The helpers here only ever bring *bounded* summaries to the
driver (one row per partition, per histogram bin or per fitted column).
"""

from __future__ import annotations

import gc
import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_SLOT_BITS = 33  # low bits of monotonically_increasing_id hold the row number


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the session; a temporary one only in local mode
    and if none is set, since executors elsewhere could not reach it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(
            configured or tempfile.mkdtemp(prefix="tabulon-checkpoint-"))
    return configured or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabulon/{name}-{uuid.uuid4().hex}"


#: Checkpoints of the innermost ``forgetting`` that is open.
_MADE: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    if (made := _MADE.get()) is not None:
        made.append(out)
        _drop_shuffles(out.sparkSession)
    return out


@contextmanager
def forgetting(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Checkpoints made inside are deleted at the end, but for those taken out of
    the list; so are the shuffles of frames that nothing refers to any more."""
    made: list[DataFrame] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for df in made:
            _delete_checkpoint(df)
        made.clear()
        _drop_shuffles(spark)


def _drop_shuffles(spark: SparkSession) -> None:
    """Spark deletes shuffle files once their frames are collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete_checkpoint(df: DataFrame) -> None:
    plan = df._jdf.queryExecution().logical()
    file = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
    if file is not None and file.isDefined():
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def only_row(df: DataFrame) -> Row:
    """The single row of a fitted statistic."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row of state, found {len(rows)}")
    return rows[0]


def bounded_rows(df: DataFrame, bound: int, what: str) -> list[Row]:
    """Collect a table that must stay small; refuse it when it does not."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} holds more than {bound} rows")
    return rows


def with_ordinal(df: DataFrame, order: list, name: str = "ordinal", keep: list[str] | None = None) -> DataFrame:
    """0-based position of every row in the total order ``order``.

    Range-partitioned sort, then per-partition offsets; no single-task window.
    ``order`` must identify rows uniquely for a reproducible result.
    With ``keep`` only these columns are written.
    """
    placed = df.sort(*order).withColumn("_slot", F.monotonically_increasing_id())
    placed = cut_lineage(placed if keep is None else placed.select(*keep, "_slot"))
    part = F.shiftright("_slot", _SLOT_BITS)
    counts = {r["p"]: r["n"] for r in
              placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    start = F.lit(offsets).cast("array<bigint>")
    within = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return placed.withColumn(name, F.get(start, part.cast("int")) + within).drop("_slot")


#: Pivots of a pass over an order, and rows that are few enough to look at.
ORDER_PIVOTS, ORDER_ROWS = 32, 2000


def first_rows(df: DataFrame, order: list, ranks: list[int], total: int) -> list[Column] | None:
    """For each rank a condition that holds for so many rows: the first ones in
    the ascending order ``order`` (nulls first).

    Nothing is sorted or written: a pass counts rows between a few pivots, drawn
    by hash from the interval that holds the wanted row, and narrows it.  None
    if a boundary falls between rows that are equal in ``order``.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_k{i}" for i in range(len(by))]
    keys = df.select(*[c.alias(n) for c, n in zip(by, names)])
    types = dict(keys.dtypes)

    def point(values, cols=None) -> Column:
        parts = cols if values is None else [F.lit(v).cast(types[n]) for v, n in zip(values, names)]
        return F.struct(*[p.alias(n) for p, n in zip(parts, names)])

    here = point(None, [F.col(n) for n in names])

    def inside(low, high) -> Column:
        above = F.lit(True) if low is None else here > point(low)
        return above if high is None else above & (here <= point(high))

    found: dict[int, tuple | None] = {}
    for rank in sorted({r for r in ranks if 0 < r < total}):
        low = high = None
        below, size, turn = 0, total, 0
        while size > ORDER_ROWS:
            some = keys.where(inside(low, high))
            drawn = some.orderBy(F.xxhash64(*names, F.lit(turn))).limit(ORDER_PIVOTS)
            pivots = [tuple(r) for r in drawn.distinct().orderBy(*names).collect()]
            place = F.lit(0)
            for p in pivots:
                place = place + (here > point(p)).cast("int")
            counts = {r["b"]: r["n"] for r in some.groupBy(place.alias("b")).agg(F.count("*").alias("n")).collect()}
            b = 0
            while below + counts.get(b, 0) < rank:  # the last of the first rows
                below, b = below + counts.get(b, 0), b + 1
            low, high, turn = pivots[b - 1] if b else low, pivots[b] if b < len(pivots) else high, turn + 1
            if counts[b] == size and len(pivots) == 1 and turn > 8:
                return None  # one key, or as good as
            size = counts[b]
        rows = [tuple(r) for r in keys.where(inside(low, high)).orderBy(*names).limit(ORDER_ROWS + 1).collect()]
        last = rows[rank - below - 1]
        if rank - below < len(rows) and rows[rank - below] == last:
            return None
        found[rank] = last
    first = point(None, by)
    return [F.lit(False) if r <= 0 else F.lit(True) if r >= total else first <= point(found[r]) for r in ranks]


def spread(df: DataFrame) -> DataFrame:
    """Before a CPU-heavy map stage: rows of a scan with fewer partitions than
    cores are dealt out; a scan with enough partitions stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hash_order(*cols) -> Column:
    """Stable pseudo-random sort key."""
    return F.xxhash64(*cols)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    bins: int = 512) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of numeric columns without a sort.

    Every pass counts rows in ``bins`` equal-width bins of the intervals still
    open and narrows each to the bin holding the wanted order statistic, so a
    pass moves at most ``bins`` rows per open interval.  Infinite values are
    counted apart and keep their place below or above all others.
    """
    aggs = [f(c).alias(f"{tag}{i}") for i, c in enumerate(cols)
            for tag, f in (("n", F.count), ("a", F.min), ("b", F.max))]
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    ends = [F.count_if((F.col(c) == v)).alias(f"{tag}{i}") for i, c in enumerate(cols)
            for tag, v in (("l", -math.inf), ("h", math.inf))]
    ends = only_row(base.agg(*ends))
    base = base.select(*[F.when(~F.isnan(c) & (F.abs(c) < math.inf), F.col(c)).alias(c) for c in cols])
    top = only_row(base.agg(*aggs))
    sizes = [ends[f"l{i}"] + top[f"n{i}"] + ends[f"h{i}"] for i in range(len(cols))]
    found: dict[tuple[int, int], float] = {}
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i in range(len(cols)):
        n, low = sizes[i], ends[f"l{i}"]
        for p in probs:
            for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)} if n else ():
                if low <= rank < low + top[f"n{i}"]:
                    open_[i, rank] = (top[f"a{i}"], top[f"b{i}"], low)
                else:
                    found[i, rank] = -math.inf if rank < low else math.inf
    while open_:
        for key, (a, b, _) in list(open_.items()):
            if a == b:
                found[key] = a
                del open_[key]
        spans = sorted({(i, a, b) for (i, _), (a, b, _) in open_.items()})
        if not spans:
            break
        cells = []
        for s, (i, a, b) in enumerate(spans):
            x = F.col(cols[i])
            half = 1.0 if math.isfinite(b - a) else 0.5  # the width of a very wide interval overflows
            place = F.least(F.floor((x * half - a * half) / (b * half - a * half) * bins), F.lit(bins - 1)).cast("int")
            cells.append(F.when((x >= a) & (x <= b),
                                F.struct(F.lit(s).alias("s"), place.alias("bin"), x.alias("x"))))
        hist: dict[int, list[Row]] = {}
        rows = (base.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
                .groupBy("c.s", "c.bin")
                .agg(F.count("*").alias("n"), F.min("c.x").alias("lo"), F.max("c.x").alias("hi"))
                .collect())
        for r in sorted(rows, key=lambda r: (r["s"], r["bin"])):
            hist.setdefault(r["s"], []).append(r)
        for key, (a, b, below) in list(open_.items()):
            for r in hist[spans.index((key[0], a, b))]:
                if key[1] < below + r["n"]:
                    open_[key] = (r["lo"], r["hi"], below)
                    break
                below += r["n"]
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        n, vals = sizes[i], []
        for p in probs:
            if not n:
                vals.append(None)
                continue
            h = (n - 1) * p
            lo, hi = found[i, math.floor(h)], found[i, math.ceil(h)]
            t = h - math.floor(h)
            if lo == hi:
                vals.append(lo)
            else:
                vals.append(lo + (hi - lo) * t if math.isfinite(hi - lo) else lo * (1 - t) + hi * t)
        out[c] = vals
    return out
