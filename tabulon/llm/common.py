"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.scale import scratch_path

#: Bytes of text that a kernel sees at once; a longer single text is seen alone.
SLICE_BYTES = 8 << 20
#: Bytes of the batches that Spark hands to Python (about; a longer row is one batch).
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def light_batches(spark: SparkSession) -> None:
    """From now on the session hands batches of ``BATCH_BYTES`` to Python, unless
    its own limit is lower.  Batches are held on both sides, several times, next
    to the heap; only their size changes, never the rows."""
    limit = spark.conf.get(_BATCH_LIMIT, None) or ""
    number = re.match(r"(\d+)\s*([bkmgtp]?)b?$", limit.strip().lower())
    if number is None or int(number[1]) << 10 * " kmgtp".index(number[2].replace("b", "") or " ") > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose texts hold about ``limit`` bytes."""
    sizes = np.frombuffer(b"", np.int64)
    if batch.num_rows:
        lengths = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column)))
        sizes = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def map_text(df: DataFrame, text: str, fields: list[tuple[str, str]], make_kernel: Callable,
             limit: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed from ``text`` by a kernel that runs inside tasks.

    ``make_kernel()`` is called once a task and returns a function from a list
    of texts (bytes or None) to one list for each new field.  All columns of
    ``df`` pass through; nothing is shuffled.
    """
    light_batches(df.sparkSession)
    names = [n for n, _ in fields]
    if clash := {n.lower() for n in names} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} exist already; see fresh()")
    added = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    schema = T.StructType([*df.schema.fields, *added.fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = list(to_arrow_schema(added))
        kernel = make_kernel()
        for batch in batches:
            for part in slices(batch, text, limit):
                texts = part.column(part.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
                values = [pa.array(v, f.type) for v, f in zip(kernel(texts), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *values], names=[*part.schema.names, *names])

    return df.mapInArrow(run, schema)


def whole_scan(spark: SparkSession, path: str, *cols: str) -> DataFrame:
    """A table of the test folder, or some of its columns."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: cuts lineage and
    survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_digest(text: Column) -> Column:
    """Strong digest of a text; null and empty are alike."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits (unsigned, wraps around)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
