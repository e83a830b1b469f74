"""Registry of checked queries: a Spark callable and, where possible, the SQL
that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load(spark: SparkSession, sf: str, table: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Rounded double without negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})


def sql_rnd(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"
