"""Delimited, JSON and fitted-state sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.scale import with_ordinal


def read_pairs(spark: SparkSession, path: str | list[str], names: Sequence[str],
               types: dict[str, str] | None = None) -> DataFrame:
    """Tab-separated without any quoting; strings unless ``types`` says else."""
    schema = ", ".join(f"`{n}` {(types or {}).get(n, 'string')}" for n in names)
    return spark.read.csv(path, sep="\t", quote="", schema=schema, encoding="UTF-8")


def write_pairs(df: DataFrame, path: str) -> None:
    df.select(*[F.regexp_replace(F.col(c).cast("string"), r"[\t\r\n]+", " ").alias(c) for c in df.columns]).write.option(
        "emptyValue", "").csv(path, sep="\t", quote="")


def line_numbers(df: DataFrame, name: str = "row_id") -> DataFrame:
    """0-based line number over the files in name order: files and blocks are
    ordered by name and start, lines by their place in the block."""
    placed = df.select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                       F.monotonically_increasing_id().alias("_l"))
    return with_ordinal(placed, ["_f", "_b", "_l"], name).drop("_f", "_b", "_l")


def zip_columns(left: DataFrame, right: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Glue two tables by their line number."""
    return left.join(right, row_id)


def read_many(parts: Sequence[DataFrame], order: Sequence[str] | None = None, row_id: str = "row_id") -> DataFrame:
    """Stack tables and renumber the rows: by part, then by ``order``."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return with_ordinal(out, ["_part", *(order or out.drop("_part").columns)], row_id).drop("_part")


def read_snapshots(spark: SparkSession, path: str, channels: int, fmt: str = "yyyy.MM.dd.HH.mm.ss",
                   header: bool = False) -> DataFrame:
    """One tab-separated file (or folder) per instant, named by its time."""
    schema = ", ".join(f"ch{i} double" for i in range(channels))
    df = spark.read.csv(path, sep="\t", schema=schema, header=header)
    stamp = F.regexp_extract("_metadata.file_path", r"(\d{4}(?:\.\d{2}){5})", 1)
    return df.select(F.to_timestamp(stamp, fmt).alias("ts"), *df.columns)


def write_results_json(results: DataFrame, path: str, config: str, order: str, value: str) -> None:
    """{config: [value per fold]} - one line per configuration."""
    rows = results.groupBy(config).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))),
                                                   lambda s: s[value]).alias("v"))  # one value per fold
    rows.select(F.to_json(F.map_from_entries(F.array(F.struct(F.col(config), F.col("v"))))).alias("value")).write.text(path)


def read_results_json(spark: SparkSession, path: str, value: str = "accuracy") -> DataFrame:
    """Long table (config, fold, value) of a results file."""
    maps = spark.read.text(path, wholetext=False).select(F.from_json("value", "map<string, array<double>>").alias("m"))
    rows = maps.select(F.explode("m").alias("config", "v"))
    return rows.select("config", F.posexplode("v").alias("fold", value))


def write_features(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def read_features(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return spark.read.schema(schema).format(fmt).load(path)


def save_state(state: DataFrame, path: str) -> None:
    """Fitted state is a table; MLlib models have their own writers."""
    state.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """A fitted MLlib model of any class, as ``save_model`` wrote it: its metadata
    name the class."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
