"""Divergence of sources from their language and from each other.

Texts are factored into whitespace chunks; every distinct chunk of the corpus is
split into terms once, its terms are joined back to the chunk's rows, and
documents and occurrences are added up by term.  From the counts each group
(language and source) gets shares of the language's kept terms in whole
billionths, and all further arithmetic is on whole numbers.

Pairs of sources are compared on a grid: terms are dealt into buckets by hash
and sources into blocks, and a task compares two blocks on one bucket.  Terms
that neither block holds are never built; what they add is known from the
number of kept terms.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.common import stored
from tabulon.llm.factors import answered, by_slice, factored

#: Runs of letters; every byte of a character outside ASCII counts as one.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Shares are in parts of so many.
UNITS = 1_000_000_000
#: Bytes of text whose terms are added up at once.
SLICE_BYTES = 12 << 20
#: Documents of a language that hold a kept term, at least.
MIN_DOCS = 10
#: Expected terms of a bucket and sources of a block.
BUCKET_TERMS, BLOCK_SOURCES = 4096, 64


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Groups ``lang``, ``source`` that occur, and rows ``lang``, ``source``,
    ``term``, ``n_docs``, ``n`` (documents with the term and its occurrences)
    that add up to those of the corpus.

    Null text, language and source are empty ones.  Every row is a document,
    repeated rows too.  Only A-Z are lower-cased.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    # bytes.split cuts at the six ASCII blanks alone
    table = factored(plain, "text", ["lang", "source"], lambda: bytes.split, limit=SLICE_BYTES)

    def terms():
        # a term has no blank, so its chunk's terms are joined by one
        return lambda chunks: [b" ".join(_TERM.findall(c.lower())) for c in chunks]

    counts = by_slice(table, answered(table, terms), _add_slice, "lang string, source string, term string, n_docs long, n long")
    groups = table.where(F.col("words").isNull()).select(F.inline("kept")).distinct()
    return groups, counts


def _add_slice(rows: pa.Array, n_bytes: pa.Array, answers: list[bytes], n_docs, places, times) -> pa.Table:
    """Documents and occurrences of the terms of a slice by group."""
    kept = rows.to_pylist()
    names = sorted({(k["lang"], k["source"]) for k in kept})
    number = {g: i for i, g in enumerate(names)}
    group = np.array([number[k["lang"], k["source"]] for k in kept], np.int64)
    n_terms = np.fromiter((a.count(b" ") + (a != b"") for a in answers), np.int64, len(answers))
    seen: dict = {}
    term = np.fromiter((seen.setdefault(t, len(seen)) for a in answers for t in a.split()), np.int64, int(n_terms.sum()))
    # one entry for every document of the chunk of every term
    chunk = np.repeat(np.arange(len(answers)), n_terms)
    answers.clear()
    reps = n_docs[chunk]
    upto = np.cumsum(reps)
    at = np.repeat((np.cumsum(n_docs) - n_docs)[chunk] - (upto - reps), reps) + np.arange(int(reps.sum()))
    key, back = np.unique(np.repeat(term, reps) * len(group) + places[at], return_inverse=True)  # a document and a term meet once
    total = np.zeros(len(key), np.int64)
    np.add.at(total, back, times[at])
    del at, back, reps, upto, chunk, term
    cell, back = np.unique(key // len(group) * len(names) + group[key % len(group)], return_inverse=True)
    n = np.zeros(len(cell), np.int64)
    np.add.at(n, back, total)
    spelled, which = list(seen), (cell % len(names)).tolist()
    return pa.table({
        "lang": pa.array([names[i][0] for i in which], pa.string()), "source": pa.array([names[i][1] for i in which], pa.string()),
        "term": pa.array([spelled[i].decode() for i in (cell // len(names)).tolist()], pa.string()),
        "n_docs": pa.array(np.bincount(back, minlength=len(cell)).astype(np.int64)), "n": pa.array(n)})


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNITS * (count + 2) / (total + 2 * kept)), exactly."""
    wide = "decimal(20,0)"
    return _div(F.lit(UNITS).cast("decimal(10,0)") * (count + 2).cast(wide), (total + 2 * kept).cast(wide)) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2**31, so longs suffice."""
    return _div((p - q) * (p - q), p + q)


def audit(docs: DataFrame, top: int = 10, min_docs: int = MIN_DOCS, **columns: str) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: part
    ``pair`` has for each group every other source of its language, part
    ``term`` the ``top`` kept terms with larger shares than in the language.

    A language keeps the terms in at least ``min_docs`` of its documents.  A
    share is one plus the whole billionths of (occurrences + 2) among (those of
    all kept terms + 2 for each); a value is the floor of (p - q)^2 / (p + q),
    for pairs summed over all kept terms.  Ranks go by value, largest first,
    then by the UTF-8 bytes of the item.  A language that keeps no term has
    pairs of value 0; a lone source has no pairs; an empty table gives no rows.
    ``columns`` name the columns ``text``, ``lang`` and ``source``; null counts
    as empty, other columns of any name are not read.
    """
    groups, parts = term_counts(docs, **columns)
    # dealt by language and term once: sums by source and sums over sources follow without another shuffle
    counts = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    of_term = Window.partitionBy("lang", "term")
    entries = stored(counts.withColumns({"df": F.sum("n_docs").over(of_term), "all": F.sum("n").over(of_term)}).where(
        F.col("df") >= min_docs).select("lang", "source", "term", "n", "all"), "entries")
    each = entries.groupBy("lang", "term").agg(F.max("all").alias("all"))
    by_lang = each.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources")).withColumnRenamed("lang", "l2")
    zero = F.lit(0).cast("long")
    groups = stored(
        groups.join(totals, ["lang", "source"], "left").join(by_lang, F.col("lang") == F.col("l"), "left")
        .join(sources, F.col("lang") == F.col("l2"))
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"),
                F.coalesce("lang_total", zero).alias("lang_total"), F.ceil(F.col("sources") / BLOCK_SOURCES).alias("blocks")),
        "groups")
    groups = groups.withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("kept") / BUCKET_TERMS))).withColumn(
        "block", F.pmod(F.xxhash64("source"), F.col("blocks"))).withColumn(
        "none", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))).otherwise(zero))
    shared = entries.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    return _pairs(groups, shared).unionByName(_terms(shared, top))


def _terms(shared: DataFrame, top: int) -> DataFrame:
    """Kept terms that a group uses more than its language does."""
    scored = shared.withColumn("q", share(F.col("all"), F.col("lang_total"), F.col("kept"))).where(F.col("p") > F.col("q"))
    scored = scored.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                           distance(F.col("p"), F.col("q")).alias("value"))
    # the limit on the rank also holds in each task before rows move
    return scored.withColumn("rank", F.row_number().over(_ranking())).where(F.col("rank") <= top)


def _ranking():
    return Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")


def _pairs(groups: DataFrame, shared: DataFrame) -> DataFrame:
    """Values of all pairs of a language's sources."""
    # a source stands in each bucket with its share of absent terms, and so does every term it holds
    there = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))).select(
        "lang", "source", "bucket", "block", "blocks", F.lit(None).cast("string").alias("term"), F.col("none").alias("p"))
    held = shared.select("lang", "source", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), "block", "blocks", "term", "p")
    rows = there.unionByName(held).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "source", "term", "p")
    excess = rows.groupBy("lang", "bucket", "low", "high").applyInArrow(
        _compare_blocks, "lang string, a string, b string, none_a long, none_b long, excess long")
    both = excess.groupBy("lang", "a", "b").agg(
        F.sum("excess").alias("excess"), F.max("none_a").alias("none_a"), F.max("none_b").alias("none_b"))
    sizes = groups.select("lang", F.col("source").alias("a"), F.col("kept"))
    base = F.when(F.col("kept") > 0, F.col("kept") * distance(F.col("none_a"), F.col("none_b"))).otherwise(0)
    valued = both.join(sizes, ["lang", "a"]).select("lang", "a", "b", (F.col("excess") + base).alias("value"))
    one_way = lambda s, t: F.struct(F.col(s).alias("source"), F.col(t).alias("item"))
    pairs = valued.select("lang", "value", F.inline(F.array(one_way("a", "b"), one_way("b", "a")))).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(_ranking()))


def _compare_blocks(rows: pa.Table) -> pa.Table:
    """For each pair of sources of two blocks the sum, over the bucket's terms
    that one of the blocks holds, of their value beyond that of an absent term."""
    low, high = (rows[c][0].as_py() for c in ("low", "high"))
    names, terms = rows["source"].to_pylist(), rows["term"].to_pylist()
    block, p = rows["block"].to_numpy(), rows["p"].to_numpy()
    here = sorted({(b, n) for b, n in zip(block.tolist(), names, strict=True)})
    number = {n: i for i, (_, n) in enumerate(here)}
    source = np.array([number[n] for n in names], np.int64)
    seen: dict = {}
    term = np.array([-1 if t is None else seen.setdefault(t, len(seen)) for t in terms], np.int64)
    none = np.zeros(len(here), np.int64)
    none[source[term < 0]] = p[term < 0]
    table = np.repeat(none[:, None], len(seen), axis=1)
    table[source[term >= 0], term[term >= 0]] = p[term >= 0]
    first, second, found = [], [], []
    of_block = np.array([b for b, _ in here])
    for i in np.flatnonzero(of_block == low).tolist():
        others = np.flatnonzero(of_block == high)
        others = others[others > i]
        if not len(others):
            continue
        value = _distance(table[others], table[i]).sum(axis=1) - len(seen) * _distance(none[others], none[i])
        first.append(np.full(len(others), i))
        second.append(others)
        found.append(value)
    first, second, found = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (first, second, found))
    spelled = np.array([n for _, n in here], object)
    return pa.table({"lang": pa.array([rows["lang"][0].as_py()] * len(first), pa.string()),
                     "a": pa.array(spelled[first].tolist(), pa.string()), "b": pa.array(spelled[second].tolist(), pa.string()),
                     "none_a": pa.array(none[first]), "none_b": pa.array(none[second]), "excess": pa.array(found)})


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // np.maximum(p + q, 1)
