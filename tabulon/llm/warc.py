"""Content-addressed WARC archive.

An archive below a folder is two Parquet tables: ``payloads`` holds the bytes
of every distinct payload once under its SHA-256, ``headers`` the exact header
block of every record with the digest of its payload.  Reading joins the two,
checks the digest of every payload it meets and gives back whole records.

Equal payloads meet by digest with map-side partial aggregation, so thousands
of copies of a page move as one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: RFC 4648 alphabet, fixed.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ID = "urn:tabulon:page:"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of binary ``payload``: each five hex
    digits are four letters."""
    digest = F.sha1(payload)

    def letters(k: int) -> list[Column]:
        n = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]

    return F.concat(*[c for k in range(8) for c in letters(k)])


def records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
            min_bytes: int = 0) -> DataFrame:
    """A record for each page without its payload: ``page_id``, ``url``,
    ``digest`` (SHA-256 of the payload), its ``length`` and ``sha1`` (base32)
    and the fields of its header.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the largest key is a response and the others revisit it; rows that share
    this largest key (repeated rows) are all responses.  A null key is smaller
    than any other.  A null body is an empty payload.
    """
    base = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(body).cast("binary"), F.lit(b"")).alias("payload"))
    # what headers need of a payload comes from the scan; no payload is shuffled
    base = base.select("page_id", "url", F.unhex(F.sha2("payload", 256)).alias("digest"),
                       F.length("payload").cast("long").alias("length"), base32_sha1(F.col("payload")).alias("sha1"))
    top = base.where(F.col("length") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("_top"))
    joined = base.join(top, "digest", "left")
    revisit = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return joined.select("page_id", "url", "digest", "length", "sha1",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("_top")).alias("refers_to"))


def header_block(length: Column) -> Column:
    """Exact header bytes of a record, blank line included."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    held = F.when(F.col("record_type") == "revisit", F.lit(0).cast("long")).otherwise(length)
    clean = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", "%0A")
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("record_type") == "revisit", line("WARC-Refers-To", name(F.col("refers_to")))).otherwise(""),
        line("WARC-Payload-Length", length.cast("string")), line("Content-Length", held.cast("string")),
        F.lit("\r\n")).cast("binary")


def write_archive(pages: DataFrame, path: str, **options) -> str:
    """Write the two tables below ``path``; returns it.  Options as in :func:`records`."""
    recs = records(pages, **options)
    recs.select(header_block(F.col("length")).alias("header"), "digest").write.parquet(f"{path}/headers")
    body = options.get("body", "html")
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    (pages.select(payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
     .groupBy("digest").agg(F.first("payload").alias("payload"))
     .write.parquet(f"{path}/payloads"))
    return path


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), f"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: ``header`` and ``payload`` bytes as written, and
    the header's fields.  A missing payload or one that does not have its digest
    ends the job."""
    heads = spark.read.parquet(f"{path}/headers")
    bodies = spark.read.parquet(f"{path}/payloads")
    # verified where it is stored once, before copies fan out; what is told of a payload comes of the verified bytes
    checked = F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.lit("payload does not have its digest")))
    bodies = bodies.select("digest", checked.alias("payload"), F.length(checked).cast("long").alias("stored_bytes"),
                           base32_sha1(checked).alias("stored_sha1"))
    joined = heads.join(bodies, "digest", "left")
    parsed = joined.select(
        "header", "payload", _field("WARC-Type").alias("record_type"),
        _page(_field("WARC-Record-ID")).alias("page_id"), _page(_field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _field("WARC-Payload-Length").cast("long").alias("payload_bytes"),
        _field("WARC-Target-URI").alias("url"), "stored_bytes", "stored_sha1")
    agree = (F.col("stored_bytes") == F.col("payload_bytes")) & (F.col("stored_sha1") == F.col("payload_digest"))

    def verified(c):
        """The column of a record whose stored payload is there and as its header says."""
        return F.when(agree, F.col(c)).otherwise(F.raise_error(F.when(
            F.col("stored_bytes").isNull(), F.lit("payload is missing")).otherwise(F.lit("header and payload differ"))))

    return parsed.select("header", verified("payload").alias("payload"), "record_type", "page_id", "refers_to",
                         verified("stored_sha1").alias("payload_digest"), verified("stored_bytes").alias("payload_bytes"), "url")


def _page(name: Column) -> Column:
    return F.regexp_extract(name, f"{_ID}(-?[0-9]+)", 1).try_cast("long")


def record_bytes() -> Column:
    """A record as it stands in a WARC file: header, block, two line ends; a
    revisit has no block."""
    return F.concat(F.col("header"), F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload")),
                    F.lit(b"\r\n\r\n"))
