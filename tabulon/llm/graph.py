"""Connected components of an edge table, and maps over whole groups of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every node hands its larger (``large``) or smaller
    neighbours to its smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    # a hub has one row in ``least``; adaptive execution splits its neighbours
    met = near.join(least, near["u"] == least["k"])
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node) of every node of the edges ``a, b``.

    Large-star and small-star steps by turns; every round is written to the
    shared folder, so its lineage ends there.  Rounds grow with the logarithm of
    the longest chain.  Nothing but two numbers a round reaches the driver.
    """
    now, before = stored(edges.where("a != b").distinct(), "edges"), None
    while True:
        now = stored(_star(_star(now, True), False), "edges")
        # equal edge sets have equal sums; a star forest maps to itself
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def map_groups(df: DataFrame, keys: list[str], schema: str, fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
               order: list[str] | None = None, at_once: int = 1) -> DataFrame:
    """Hash rows by ``keys`` and call ``fn`` for each group, or for runs of whole
    groups of about ``at_once`` rows; much cheaper than a grouped UDF when groups
    are many and small.  Groups must be bounded by the caller."""
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches):
        held, last, rows = [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            change = None
            for c in cols:
                differs = pa.compute.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
                change = differs if change is None else change | differs
            borders = change.nonzero()[0] + 1
            if held and tuple(c[0].as_py() for c in cols) != last:
                borders = np.append(0, borders)
            begin = 0
            # from border to border at which enough rows are held
            while (k := int(np.searchsorted(borders, begin + at_once - rows))) < len(borders):
                end, borders = int(borders[k]), borders[k + 1:]
                held.append(batch.slice(begin, end - begin))
                yield from fn(pa.Table.from_batches(held))
                held, rows, begin = [], 0, end
            held.append(batch.slice(begin))
            rows += batch.num_rows - begin
            last = tuple(c[batch.num_rows - 1].as_py() for c in cols)
        if held:
            yield from fn(pa.Table.from_batches(held))

    return placed.mapInArrow(run, schema)
