"""Texts factored into their distinct words, slice by slice.

A slice is a run of documents of a scan, about ``limit`` bytes of text that one
task reads at once.  It is written as one row with the frequencies of its words
in its documents, and its distinct words are dealt by hash into buckets, one row
for each.  A task takes a bucket of all slices, works out what each distinct
word stands for once, and answers every slice in the order it asked; slices are
joined with their answers.  A word that is everywhere is asked for once a slice,
so no bucket is hot.  Words and numbers travel packed, not as a row each.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import slices, stored

#: Bytes of text of a slice, and most documents in it.
FACTOR_BYTES, FACTOR_DOCS = 16 << 20, 20_000
#: Buckets of words; a task holds the distinct words of one at a time.
BUCKETS = 4096
_TEXT = "text"
_LEVEL = 5  # of compression


def _planes(column: np.ndarray) -> bytes:
    """32-bit numbers by byte, so that the zeros of small ones lie together."""
    return column.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes, n: int, at: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(n).astype(np.int64)


def pack(words: Sequence[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return zlib.compress(np.array([len(words)], "<i4").tobytes() + _planes(sizes) + b"".join(words), _LEVEL)


def unpack(packed: bytes) -> list[bytes]:
    raw = zlib.decompress(packed)
    n = int(np.frombuffer(raw, "<i4", 1)[0])
    ends = (np.cumsum(_from_planes(raw, n, 4)) + 4 * (n + 1)).tolist()
    return [raw[a:b] for a, b in zip([4 * (n + 1), *ends], ends, strict=False)]


def pack_numbers(*columns: np.ndarray) -> bytes:
    sizes = np.array([len(columns), *map(len, columns)], "<i8")
    return zlib.compress(sizes.tobytes() + b"".join(map(_planes, columns)), _LEVEL)


def unpack_numbers(packed: bytes) -> list[np.ndarray]:
    raw = zlib.decompress(packed)
    k = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", k, 8).tolist()
    starts = (8 * (k + 1) + 4 * (np.cumsum(sizes) - sizes)).tolist()
    return [_from_planes(raw, n, a) for n, a in zip(sizes, starts, strict=True)]


def factored(docs: DataFrame, text: str, keep: Sequence[str], make_split: Callable, limit: int = FACTOR_BYTES,
             buckets: int = BUCKETS) -> DataFrame:
    """Written table of ``slice``, ``bucket``, ``words`` (a packed list; rows of
    words) and ``slice``, ``kept``, ``n_bytes``, ``found`` (rows of slices, where
    ``words`` is null): the columns named by ``keep`` and the size of every
    document, and packed, for each word by bucket, its number of documents,
    the steps between their places and how often it occurs in each.

    ``make_split()`` is called once a task and returns a function from a text
    in UTF-8 to a list of words.  Null and empty texts have no words; equal rows
    of ``docs`` are documents of their own.
    """
    plain = docs.select(F.col(text).cast("binary").alias(_TEXT), F.struct(*[F.col(c) for c in keep]).alias("kept"))
    schema = T.StructType([*T._parse_datatype_string("slice long, bucket int, words binary, n_bytes array<long>, found binary").fields,
                           T.StructField("kept", T.ArrayType(plain.schema["kept"].dataType))])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, split, number = to_arrow_schema(schema), make_split(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lot in slices(batch, _TEXT, limit):
                for b in range(0, lot.num_rows, FACTOR_DOCS):
                    part = lot.slice(b, FACTOR_DOCS)
                    texts = part.column(part.schema.get_field_index(_TEXT))
                    words, places, n_docs, found = occurrences(texts, split, buckets)
                    ends = np.flatnonzero(np.append(np.diff(places), 1)) + 1 if len(places) else np.zeros(0, np.int64)
                    n, m = len(ends), part.num_rows
                    packed = [pack(words[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
                    columns = {"slice": pa.array(np.full(n + 1, number)),
                               "bucket": pa.array([None, *places[ends - 1].tolist()], pa.int32()),
                               "words": pa.array([None, *packed], arrow.field("words").type),
                               "found": pa.array([pack_numbers(n_docs, *found), *[None] * n], arrow.field("found").type)}
                    sizes = pa.compute.binary_length(texts).fill_null(0).cast(pa.int64())
                    whole = part.column(part.schema.get_field_index("kept"))
                    for c, v in (("n_bytes", sizes), ("kept", whole)):
                        one = pa.ListArray.from_arrays(pa.array([0, m], pa.int32()), v).cast(arrow.field(c).type)
                        columns[c] = pa.concat_arrays([one, pa.nulls(n, one.type)])
                    yield pa.RecordBatch.from_arrays([columns[c] for c in schema.names], schema=arrow)
                    number += 1

    return stored(plain.mapInArrow(run, schema), "factored")


def occurrences(texts: pa.Array, split: Callable, buckets: int):
    """Distinct words by bucket, their buckets and numbers of documents, and for
    each word the steps from place to place of its documents and how often it occurs in
    each."""
    seen: dict = {}
    ids, times, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for t in texts.to_pylist():
        here = Counter(split(t)) if t else ()
        sizes.append(len(here))
        if here:
            ids.append(np.array([seen.setdefault(w, len(seen)) for w in here], np.int64))
            times.append(np.fromiter(here.values(), np.int64, len(here)))
    words = list(seen)
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    word = rank[np.concatenate(ids)]
    by_word = np.argsort(word, kind="stable")
    place = np.repeat(np.arange(len(sizes)), sizes)[by_word]
    step = np.diff(place, prepend=0)  # small within a word
    return ([words[i] for i in order.tolist()], bucket[order], np.bincount(word, minlength=len(words)),
            (step, np.concatenate(times)[by_word]))


def answered(table: DataFrame, make_answer: Callable) -> DataFrame:
    """``slice``, ``bucket``, ``answers``: for each row of words a packed list.
    ``make_answer()`` is called once a task and returns a function from a list
    of words to a list of answers (bytes); a task calls it with every distinct
    word of a bucket once."""
    asked = table.where(F.col("words").isNotNull()).select("slice", "bucket", "words")

    def run(batches):
        answer, bucket, known = make_answer(), None, {}
        for batch in batches:
            for b in range(0, batch.num_rows, 64):
                part, out = batch.slice(b, 64), []
                for place, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    if place != bucket:
                        bucket, known = place, {}
                    words = unpack(packed)
                    fresh = [w for w in words if w not in known]
                    known.update(zip(fresh, answer(fresh), strict=True))
                    out.append(pack([known[w] for w in words]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["slice", "bucket", "answers"])

    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "slice long, bucket int, answers binary")


def by_slice(table: DataFrame, answers: DataFrame, kernel: Callable, schema: T.StructType) -> DataFrame:
    """Join slices with their answers and call ``kernel(kept, n_bytes, answers,
    n_docs, places, times)`` for each; it returns an Arrow table.  A slice's
    answers follow the order of its words."""
    whole = table.where(F.col("words").isNull()).select(
        F.col("slice").alias("slice"), "kept", "n_bytes", "found")  # fresh: both sides come from one table

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        given = sorted(zip(right["bucket"].to_pylist(), right["answers"].to_pylist(), strict=True))
        words = [a for _, packed in given for a in unpack(packed)]
        kept, n_bytes = (left[c].combine_chunks().flatten() for c in ("kept", "n_bytes"))
        n_docs, steps, times = unpack_numbers(left["found"][0].as_py())
        return kernel(kept, n_bytes, words, n_docs, np.cumsum(steps), times)

    return whole.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, schema)
