"""Attribute-relation files.

The header of one file gives the schema; data lines of all files are parsed on
the executors with the built-in CSV expression."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: one attribute line - a bare or quoted name, then its type.
ATTRIBUTE = re.compile(r"""@attribute\s+('(?:[^']|\\')*'|"[^"]*"|\S+)\s+(.*)$""", re.IGNORECASE)
NUMERIC_TYPES = ("real", "numeric", "integer")
#: Files whose ``@data`` places are broadcast; beyond that they are joined.
MAX_BROADCAST_FILES = 100_000


@dataclass(frozen=True)
class Attribute:
    name: str
    levels: tuple[str, ...] | None  # None for numeric attributes

    def field(self) -> T.StructField:
        meta = {} if self.levels is None else {"levels": list(self.levels)}
        return T.StructField(self.name, T.DoubleType() if self.levels is None else T.StringType(), True, meta)


def _unquote(text: str) -> str:
    text = text.strip()
    return text[1:-1] if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"" else text


def parse_attribute(line: str) -> Attribute:
    m = ATTRIBUTE.match(line.strip())
    if m is None:
        raise ValueError(f"not an attribute line: {line!r}")
    name, kind = _unquote(m.group(1)), m.group(2).strip()
    if kind.startswith("{"):
        inner = kind[1:kind.rindex("}")]
        levels = re.findall(r"'[^']*'|\"[^\"]*\"|[^,]+", inner)
        return Attribute(name, tuple(_unquote(v) for v in levels if v.strip()))
    if kind.split("[")[0].strip().lower() in NUMERIC_TYPES:
        return Attribute(name, None)
    raise ValueError(f"unsupported attribute type: {kind!r}")


def _lines(spark: SparkSession, path) -> DataFrame:
    """Text lines with their file and a number that orders them in a file
    block; headers sit in the first block of a file."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("line")).alias("_start"))


def read_arff(spark: SparkSession, path: str | list[str], keep_missing_level: bool = False,
              keep_file: bool = False) -> DataFrame:
    """Numeric attributes as double, nominal ones as string with the declared
    levels in the column metadata; ``?`` is null, or a level of its own with
    ``keep_missing_level``. All files must declare the same attributes."""
    lines = _lines(spark, path)
    # a line is header or data by its place in the file, not by how it begins
    is_mark = F.lower(F.trim("value")).rlike(r"^@data\b")
    places = lines.groupBy("_file").agg(F.min(F.when(is_mark, F.col("_start"))).alias("_data"))
    seen = places.agg(F.count("*").alias("files"), F.count("_data").alias("marked")).first()
    if seen["files"] > seen["marked"]:
        raise ValueError(f"{seen['files'] - seen['marked']} files below {path} have no @data line")
    lines = lines.join(F.broadcast(places) if seen["files"] <= MAX_BROADCAST_FILES else places, "_file")
    declared = lines.where((F.col("_start") < F.col("_data")) & F.lower(F.ltrim("value")).startswith("@attribute"))
    # same header everywhere: compare one fingerprint per distinct header
    by_file = declared.groupBy("_file").agg(F.transform(F.array_sort(F.collect_list(
        F.struct("_start", F.trim("value").alias("v")))), lambda s: s["v"]).alias("lines"))
    alike = F.lower(F.regexp_replace(F.array_join("lines", "\n"), r"[ \t]+", " "))
    kinds = by_file.groupBy(alike.alias("h")).agg(F.min(F.struct("_file", "lines")).alias("first"), F.count("*").alias("n"))
    kinds = kinds.orderBy(F.desc("n"), "first._file").limit(2).collect()
    if not kinds:
        raise ValueError(f"no @attribute lines below {path}")
    if len(kinds) > 1:
        raise ValueError(f"file {kinds[1]['first']['_file']} declares other attributes than {kinds[0]['first']['_file']}")
    if seen["files"] != kinds[0]["n"]:
        raise ValueError(f"{seen['files'] - kinds[0]['n']} files below {path} have no attribute header")
    attributes = [parse_attribute(v) for v in kinds[0]["first"]["lines"]]
    # read every cell as text first, so that quoting and blanks are uniform
    raw = ", ".join(f"c{i} string" for i in range(len(attributes)))
    is_row = (F.col("_start") > F.col("_data")) & ~F.col("value").rlike(r"^\s*(?:%|$)")
    body = lines.where(is_row).select(
        "_file", F.from_csv("value", raw, {"quote": "'", "ignoreLeadingWhiteSpace": "true",
                                           "ignoreTrailingWhiteSpace": "true"}).alias("r"))
    cells = []
    for i, a in enumerate(attributes):
        cell = F.trim(F.col(f"r.c{i}"))
        cell = F.regexp_replace(cell, r'^"(.*)"$', "$1")
        if a.levels is None or not keep_missing_level:
            cell = F.nullif(cell, F.lit("?"))
        cell = cell.cast("double") if a.levels is None else cell
        cells.append(cell.alias(a.name, metadata=a.field().metadata))
    return body.select(*cells, *([F.col("_file").alias("file_path")] if keep_file else []))


def write_arff(df: DataFrame, path: str, relation: str, levels: dict[str, list[str]]) -> None:
    """One file per partition, each with the header in front of its rows."""
    head = [f"@relation {relation}"]
    for c in df.columns:
        kind = "{" + ",".join(f"'{v}'" if re.search(r"[\s,]", v) else v for v in levels[c]) + "}" if c in levels else "real"
        head.append(f"@attribute {c} {kind}")
    head.append("@data")
    cells = []
    for c in df.columns:
        text = F.col(c).cast("string")
        if c in levels:
            text = F.when(text.rlike(r"[\s,]"), F.concat(F.lit("'"), text, F.lit("'"))).otherwise(text)
        cells.append(F.coalesce(text, F.lit("?")))
    body = df.select(F.concat_ws(",", *cells).alias("value"))
    header = "\n".join(head)

    def with_header(parts):
        import pandas as pd
        first = True
        for pdf in parts:
            if len(pdf):
                yield pd.concat([pd.DataFrame({"value": [header]}), pdf]) if first else pdf
                first = False

    body.mapInPandas(with_header, "value string").write.text(path)


def read_folds(spark: SparkSession, path: str, keep_missing_level: bool = False) -> DataFrame:
    """All ``*.fold.<n>.train.arff`` / ``*.fold.<n>.test.arff`` files as one
    table; the pair key is the number in the name, never the listing order."""
    df = read_arff(spark, path, keep_missing_level, keep_file=True)
    name = r"fold\.(\d+)\.(train|test)"
    return df.withColumns({
        "fold": F.regexp_extract("file_path", name, 1).cast("int"),
        "split": F.regexp_extract("file_path", name, 2)}).drop("file_path")
