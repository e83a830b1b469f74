"""Registered queries of the operators: thin projections of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.scale import scratch_path
from tabulon.llm import (decontamination, divergence, fingerprints, jaccard, language, pieces, quality, repeats, secrets, sql,
                         token_counts, toxicity, turns, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet").select(*cols)


@query("op1_decontamination", sql.DECONTAMINATION)
def op1(spark, sf):
    found = decontamination.annotate(table(spark, sf, "documents", "doc_id", "text"),
                                     table(spark, sf, "benchmark", "item_id", "text"), out="_c")
    return found.select(
        "doc_id", F.col("_c.n_words").alias("n_words"), decontamination.n_hit("_c").alias("n_hit"),
        F.size("_c.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_c.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_c.runs") > 0).alias("contaminated"))


@query("op5_warc", sql.WARC)
def op5(spark, sf):
    path = warc.write_archive(table(spark, sf, "pages", "page_id", "url", "html"), scratch_path(spark, "warc"))
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_language_id")
def op6(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    held = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    docs = docs.withColumn("held_out", F.coalesce(held, F.lit(False)))
    model = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


@query("op7_fingerprints")
def op7(spark, sf):
    return fingerprints.compare_with_next(table(spark, sf, "documents", "doc_id", "text"))


@query("op3_quality")
def op3(spark, sf):
    """Grades of the labels: 0 junk, 1 good but toxic, 2 good."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    labels = table(spark, sf, "labels", "doc_id", "quality", "toxic").withColumn(
        "grade", F.col("quality") * (2 - F.col("toxic")))
    scored = quality.score(docs, quality.fit(docs, labels, "grade"), 1)
    return scored.select("doc_id", "expected_grade", "p_tail", (F.col("p_tail") >= quality.THRESHOLD).alias("keep"))


def toxic_labels(spark, sf):
    """The chain's categories, junk before toxic."""
    return table(spark, sf, "labels", "doc_id", "quality", "toxic").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


@query("op10_toxicity")
def op10(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    chain = toxicity.fit(docs, toxic_labels(spark, sf), ["low_quality", "toxic"])
    scored = toxicity.score(docs, chain, ["p_low_quality", "p_toxic"])
    return scored.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= toxicity.THRESHOLD).alias("toxic"))


@query("op8_secrets")
def op8(spark, sf):
    found = secrets.scan(table(spark, sf, "documents", "doc_id", "text", "source"), out="_s")
    n = lambda kind: F.size(F.filter("_s.base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(secrets.spell(F.col("_s.base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spell(F.col("_s.spans")).alias("spans"), F.col("_s.n_live").alias("n_live"),
        F.col("_s.n_copied").alias("n_copied"))


@query("op4_sentencepiece")
def op4(spark, sf):
    vocabulary = pieces.Vocabulary.load()
    encoded = pieces.encode(table(spark, sf, "documents", "doc_id", "text"), vocabulary)
    decoded = pieces.decode(encoded, vocabulary)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
                          F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op9_jaccard_join", sql.JACCARD)
def op9(spark, sf):
    return jaccard.join(table(spark, sf, "documents", "doc_id", "text"))


@query("op2_suffix_dedup")
def op2(spark, sf):
    return repeats.remove(table(spark, sf, "documents", "doc_id", "text"))


@query("op11_conversation_repair", sql.REPAIR)
def op11(spark, sf):
    rows = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    fixed = turns.repair(turns.damage(rows))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    # conversations of which the damage left nothing
    return ids.join(fixed, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


@query("op12_token_counts")
def op12(spark, sf, limit: int = 4096):
    import public_tokenizers
    vocabulary = token_counts.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts.count(table(spark, sf, "documents", "doc_id", "text"), vocabulary)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op13_source_divergence", sql.DIVERGENCE)
def op13(spark, sf):
    return divergence.audit(table(spark, sf, "documents", "text", "lang", "source"))
