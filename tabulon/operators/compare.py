"""Rank-based comparison of configurations.

Tables here hold one value per configuration and fold: small by nature, still
ranked without a single-task sort."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.pvalues import chi_square_upper
from tabulon.functions.scale import cut_lineage, only_row, with_ordinal

#: Configurations of a block of pairs; rows of a range of ordered pairs and most ranges there are.
PAIR_ROWS, BLOCK_ROWS, MAX_BLOCKS = 2048, 10_000, 10_000


def friedman(results: DataFrame, block: str, config: str, value: str) -> DataFrame:
    """Chi-square of average ranks within blocks, corrected for ties."""
    inside = Window.partitionBy(block)
    same = Window.partitionBy(block, value)
    ranked = results.select(
        block, config, (F.rank().over(inside.orderBy(value)) + (F.count("*").over(same) - 1) / 2).alias("rank"),
        F.count("*").over(same).alias("t"))
    ties = ranked.agg(F.sum(F.col("t") * F.col("t") - 1).alias("ties"), F.count_distinct(block).alias("n"),
                      F.count_distinct(config).alias("k"))
    sums = ranked.groupBy(config).agg(F.sum("rank").alias("s")).agg(F.sum(F.col("s") * F.col("s")).alias("ss"))
    t, s = only_row(ties), only_row(sums)
    n, k = t["n"], t["k"]
    correction = 1 - t["ties"] / (k * (k * k - 1) * n)
    stat = (12.0 / (k * n * (k + 1)) * s["ss"] - 3 * n * (k + 1)) / correction
    return results.sparkSession.createDataFrame(
        [(float(stat), k - 1, chi_square_upper(stat, k - 1))], "statistic double, df int, p_value double")


def _two_sided(z: str):
    @F.pandas_udf("double")
    def tail(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)))
    return tail(z)


def _pairs(table: DataFrame, key: str, rows: int = PAIR_ROWS) -> DataFrame:
    """Every two rows with ``a < b`` for their ``key``, as structs.  The keys are
    dealt to a square of blocks, so a row is copied once for each block."""
    side = max(1, -(-table.count() // rows))
    block = F.pmod(F.xxhash64(key), F.lit(side)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    whole = F.struct(*table.columns)
    a = table.select(whole.alias("a"), block.alias("i"), every.alias("j"))
    b = table.select(whole.alias("b"), every.alias("i"), block.alias("j"))
    return a.join(b, ["i", "j"]).where(F.col(f"a.{key}") < F.col(f"b.{key}")).select("a", "b")


def running_max(placed: DataFrame, ordinal: str, value: str, total: int, name: str) -> DataFrame:
    """Largest ``value`` up to each row in the order of ``ordinal`` (0 to
    ``total`` - 1): maxima of at most ``MAX_BLOCKS`` ranges reach the driver, and
    a range starts from the largest of those before it."""
    size = max(BLOCK_ROWS, -(-total // MAX_BLOCKS))
    block = F.floor(F.col(ordinal) / size).cast("int")
    highs = {r["k"]: r["m"] for r in placed.groupBy(block.alias("k")).agg(F.max(value).alias("m")).collect()}
    before, top = [], None
    for k in range(max(highs, default=0) + 1):
        before.append(top)
        high = highs.get(k)
        top = high if top is None else top if high is None else max(top, high)
    inside = Window.partitionBy("_block").orderBy(ordinal).rowsBetween(Window.unboundedPreceding, 0)
    floor = F.get(F.lit([math.nan if v is None else float(v) for v in before]), F.col("_block"))
    return placed.withColumn("_block", block).withColumn(
        name, F.greatest(F.max(value).over(inside), F.nullif(floor, F.lit(math.nan)))).drop("_block")


def dunn_holm(results: DataFrame, config: str, value: str, order: list[str]) -> DataFrame:
    """(a, b, z, p, p_holm) for every unordered pair of configurations.

    ``order`` names columns that make rows unique. The step-down maximum runs
    over ranges of the ordered pairs, so no task sees all of them."""
    placed = with_ordinal(results, [value, *order], "_o")
    ties = placed.groupBy(value).agg(F.avg("_o").alias("_r"), F.count("*").alias("_t"))
    n, tie = only_row(ties.agg(F.sum("_t").alias("n"), F.sum(F.pow("_t", F.lit(3)) - F.col("_t")).alias("s")))
    spread = n * (n + 1) / 12.0 - tie / (12.0 * (n - 1))
    mean = cut_lineage(placed.join(ties, value).groupBy(F.col(config).alias("c")).agg(
        F.avg(F.col("_r") + 1).alias("m"), F.count("*").alias("n")))
    z = F.abs(F.col("a.m") - F.col("b.m")) / F.sqrt(F.lit(float(spread)) * (1 / F.col("a.n") + 1 / F.col("b.n")))
    pairs = _pairs(mean, "c").select(F.col("a.c").alias("a"), F.col("b.c").alias("b"), z.alias("z")).withColumn("p", _two_sided("z"))
    ranked = with_ordinal(pairs, ["p", "a", "b"], "_k")
    total = ranked.count()
    raised = ranked.withColumn("_s", F.least(F.lit(1.0), (F.lit(total) - F.col("_k")) * F.col("p")))
    return running_max(raised, "_k", "_s", total, "p_holm").select("a", "b", "z", "p", "p_holm")


def pick_best(pairs: DataFrame, means: DataFrame, config: str, alpha: float = 0.05) -> DataFrame:
    """Highest mean among configurations that differ from another one (the
    first one when none beats it), marked together with all configurations not
    rejected against the first."""
    both = pairs.select("a", "b", "p_holm").unionByName(pairs.select(
        F.col("b").alias("a"), F.col("a").alias("b"), "p_holm"))
    first = means.agg(F.min(config)).first()[0]
    differs = both.groupBy(F.col("a").alias(config)).agg(
        F.max((F.col("p_holm") < alpha).cast("int")).alias("_any"),
        F.max(F.when(F.col("b") == first, F.col("p_holm"))).alias("_first"))
    table = means.join(differs, config, "left")
    start = only_row(means.where(F.col(config) == first))
    best = (table.where((F.col("_any") == 1) & (F.col("accuracy") > start["accuracy"]))
            .orderBy(F.desc("accuracy"), config).limit(1).collect())
    name = best[0][config] if best else first
    return table.select(config, "accuracy", (F.col(config) == F.lit(name)).alias("best"),
                        (F.coalesce(F.col("_first") > alpha, F.lit(False)) | (F.col(config) == F.lit(first))).alias("not_rejected"))
