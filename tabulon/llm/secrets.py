"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns find secrets by form.  On top of them every token that looks
random enough is a candidate; its hash is counted over the whole corpus by
distinct repositories and owners.  A value that few owners have looks like a
live credential of theirs and is reported; a value that many owners share is a
copied example.  Base spans always stay, they are only told apart.

A span is the whole match of its pattern, in code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import fresh, text_digest

#: Kinds in their order; ``owned`` is what the method adds.
KINDS = ("assign", "access", "hex", "owned")
#: A value of at most so many owners is owner-specific.
MAX_OWNERS = 1
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_OWNED = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])"
          r"[A-Za-z0-9+/_=-]{20,}")
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _found(text: Column, kind: int, pattern: str, group: int, least: int, gate: Column) -> Column:
    """Spans of the matches whose group has ``least`` characters or more.

    ``split`` gives what stands between the matches, so adding up lengths gives
    the places.  ``gate`` is a cheap test that every text with a match passes.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        kept = F.when(F.length(x["value"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    empty = F.array().cast(_SPAN)
    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(gate, spans.cast(_SPAN)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Sorted spans of the base kinds (start, then kind)."""
    low = F.lower(text)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("apikey") | low.contains("api_key")
    return F.array_sort(F.concat(
        _found(text, 0, _ASSIGN, 2, 8, named),
        _found(text, 1, r"AKIA[A-Z0-9]+", 0, 16, text.contains("AKIA")),
        _found(text, 2, r"[0-9a-f]+", 0, 32, text.rlike("[0-9a-f]{32}"))))


def candidate_spans(text: Column, base: Column) -> Column:
    """Random-looking tokens that touch no base span."""
    wide = _found(text, 3, _OWNED, 0, 20, text.rlike("[A-Za-z0-9+/_=-]{20}"))
    return F.filter(wide, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))


def scan(docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source",
         max_owners: int = MAX_OWNERS, max_repositories: int | None = None, out: str = "secrets") -> DataFrame:
    """``docs`` with a struct column ``out``: ``base`` and ``spans`` (arrays of
    start, kind, end, value, sorted), ``n_live`` and ``n_copied`` (spans found
    by form or candidates whose value is owner-specific or widely copied).

    With ``max_repositories`` a live value also stands in at most so many of them.
    Null texts are empty; a null owner or repository is an owner or repository
    of its own.  What a text holds depends on the text and the corpus alone, so
    results meet their rows by the text's digest; copies of a text are one row
    on one side of that join, and adaptive execution splits the other.
    """
    out = out if out.lower() not in {c.lower() for c in docs.columns} else fresh(docs, out)
    key, base, wide = (fresh(docs, c) for c in ("_digest", "_base", "_wide"))
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn(key, text_digest(F.col(text))).withColumn(base, base_spans(body))
    rows = found.select(F.col(key).alias("key"), F.col(base).alias("base"), body.alias("body"),
                        F.coalesce(F.col(owner).cast("string"), F.lit("\0")).alias("owner"),
                        F.coalesce(F.col(repository).cast("string"), F.lit("\0")).alias("repository"))
    spans = rows.select("key", "owner", "repository", F.explode(
        F.concat("base", candidate_spans(F.col("body"), F.col("base")))).alias("s"))
    spans = spans.select("key", "owner", "repository", "s", F.unhex(F.sha2(F.col("s.value").cast("binary"), 256)).alias("h"))
    # repeats within a repository, then within an owner collapse before each shuffle
    counts = (spans.groupBy("h", "owner", "repository").agg(F.count("*").alias("_"))
              .groupBy("h", "owner").agg(F.count("*").alias("r"))
              .groupBy("h").agg(F.count("*").alias("owners"), F.sum("r").alias("repositories")))
    texts = spans.select("key", "h", "s").distinct()
    live = F.col("owners") <= max_owners
    if max_repositories is not None:
        live &= F.col("repositories") <= max_repositories
    judged = (texts.join(counts, "h").groupBy("key").agg(
        F.array_sort(F.collect_list(F.when(live & (F.col("s.kind") == 3), F.col("s")))).alias("added"),
        F.count_if(live).alias("n_live"), F.count_if(~live).alias("n_copied")))
    verdict = fresh(docs, "_verdict")
    judged = judged.select(F.col("key").alias(key), F.struct("added", "n_live", "n_copied").alias(verdict))
    v, none = F.col(verdict), F.array().cast(_SPAN)
    return found.join(judged, key, "left").select(*docs.columns, F.struct(
        F.col(base).alias("base"), F.array_sort(F.concat(F.col(base), F.coalesce(v["added"], none))).alias("spans"),
        F.coalesce(v["n_live"], F.lit(0)).alias("n_live"), F.coalesce(v["n_copied"], F.lit(0)).alias("n_copied")).alias(out))


def spell(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the union of the spans replaced by ``mark``."""

    def step(acc, s):
        gap = F.when(s["start"] > acc["at"], F.concat(
            text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(
            F.when((acc["at"] == 0) & (s["start"] == 0), F.lit(mark)).otherwise(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text)))))
