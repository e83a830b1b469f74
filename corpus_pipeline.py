"""From raw documents to encoded, clean training text.

Each stage takes what its predecessor kept and all but the last return the
columns of ``documents``.  Null and empty texts pass every stage: they are not
toxic, resemble nothing, hold no benchmark window and no secret.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import decontamination, jaccard, pieces, secrets, toxicity
from tabulon.llm.common import fresh, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic stays below the threshold, and
    those without text."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.fit(docs, labels, ["low_quality", "toxic"])
    junk, toxic = fresh(docs, "_p_low_quality"), fresh(docs, "_p_toxic")
    scored = toxicity.score(docs, chain, [junk, toxic])
    silent = F.coalesce(F.length("text"), F.lit(0)) == 0
    return scored.where(silent | (F.col(toxic) < toxicity.THRESHOLD)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return jaccard.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and ``n_chars`` in step."""
    out = fresh(docs, "_secrets")
    found = secrets.scan(docs, out=out).withColumn("text", secrets.redact(F.col("text"), F.col(f"{out}.spans")))
    changed = F.size(F.col(f"{out}.spans")) > 0
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their text but with its pieces; ``exact`` tells that
    decoding them gives the text back."""
    vocabulary = pieces.Vocabulary.load()
    decoded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return decoded.select("doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_pieces"),
                          F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secrets", redact_secrets), ("sentencepiece", encode_pieces)]

#: Classifiers and tokenizers have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared
    folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
