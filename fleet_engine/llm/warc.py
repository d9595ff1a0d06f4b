"""Content-addressed WARC archive: payload bytes once per digest, exact record headers apart, records rebuilt by joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_BYTES = 1000                    # equal payloads of at least so many bytes are revisits of one response
DATE = "2024-01-01T00:00:00Z"       # capture date where the pages have none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"   # fixed value of the format
END = "\r\n"


@dataclass(frozen=True)
class Archive:
    """Folders of the two tables: ``headers`` (header, digest) and ``payloads`` (digest, payload)."""

    headers: str
    payloads: str


def _line(name: str, value: Column) -> Column:
    """One header line, or nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html",
                  min_bytes: int = MIN_BYTES, date: str = DATE) -> Archive:
    """Write one record per row below ``path``.

    A payload is the UTF-8 text, NULL being empty. Its digest is SHA-256; the header also names the SHA-1. Of records with equal payloads of at
    least ``min_bytes`` bytes those with the largest id are responses and the others revisits of it; where none has an id, and below
    ``min_bytes``, all are responses. Repeated rows become repeated records. Equal payloads meet in one grouping that combines in each task before the
    shuffle, so a payload that a third of the rows share arrives once per task; headers meet the groups without any payload.
    """
    id_ = F.col(id_col)
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    url = F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")) if url_col else F.lit(None).cast("string")
    rows = pages.select(id_.alias("_id"), url.alias("_url"), payload.alias("payload"))
    hashed = rows.withColumn("digest", F.sha2("payload", 256))
    archive = Archive(f"{path}/headers", f"{path}/payloads")
    (hashed.groupBy("digest").agg(F.first("payload").alias("payload"), F.max("_id").alias("newest"))
     .write.option("compression", "zstd").parquet(archive.payloads))
    groups = pages.sparkSession.read.parquet(archive.payloads).select("digest", "newest")
    records = hashed.select("_id", "_url", "digest", F.sha1("payload").alias("_sha1"),
                            F.octet_length("payload").alias("_bytes")).join(groups, "digest")
    revisit = F.coalesce((F.col("_bytes") >= min_bytes) & ~F.col("_id").eqNullSafe(F.col("newest")) & F.col("newest").isNotNull(), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(END),
        _line("WARC-Record-ID", urn(F.col("_id"))), _line("WARC-Target-URI", F.col("_url")), F.lit(f"WARC-Date: {date}{END}"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1"))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}"), _line("WARC-Refers-To", urn(F.col("newest"))))).otherwise(""),
        F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("_bytes")).cast("string"), F.lit(END * 2))
    records.select(F.encode(header, "UTF-8").alias("header"), "digest").write.option("compression", "zstd").parquet(archive.headers)
    return archive


def verified_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """(digest, payload); a payload whose bytes do not have their digest stops the job."""
    rows = spark.read.parquet(archive.payloads).select("digest", "payload")
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    return rows.select(F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(wrong).alias("digest"), "payload")


def read_records(spark: SparkSession, archive: Archive, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, digest_matches) from headers and verified payloads.

    Length and SHA-1 are taken from the stored bytes, once per payload, and ``digest_matches`` says whether the header names the same SHA-1.
    """
    text = F.decode("header", "UTF-8")
    field = lambda name, value="([^\\r]*)": F.nullif(F.regexp_extract(text, f"\\r\\n{name}: {value}\\r\\n", 1), F.lit(""))
    urn = "<urn:page:([^>]*)>"
    headers = spark.read.parquet(archive.headers).select(
        field("WARC-Record-ID", urn).cast(id_type).alias("page_id"), field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To", urn).cast(id_type).alias("refers_to"),
        field("WARC-Payload-Digest", "sha1:([0-9a-f]*)").alias("_named"), "digest")
    stored = verified_payloads(spark, archive).select("digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                                                      F.sha1("payload").alias("payload_digest"))
    return headers.join(stored, "digest").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("_named") == F.col("payload_digest")).alias("digest_matches"))


def rebuild_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """(header, block, record): the original records byte for byte; a revisit has an empty block."""
    headers = spark.read.parquet(archive.headers)
    revisit = F.contains(F.decode("header", "UTF-8"), F.lit(f"{END}WARC-Type: revisit{END}"))
    block = F.when(revisit, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return headers.join(verified_payloads(spark, archive), "digest").select(
        "header", block.alias("block"), F.concat("header", block, F.encode(F.lit(END * 2), "UTF-8")).alias("record"))


def read_pages(spark: SparkSession, archive: Archive, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload) of every record, revisits with the payload they refer to."""
    text = F.decode("header", "UTF-8")
    headers = spark.read.parquet(archive.headers)
    return headers.join(verified_payloads(spark, archive), "digest").select(
        F.nullif(F.regexp_extract(text, "\\r\\nWARC-Record-ID: <urn:page:([^>]*)>\\r\\n", 1), F.lit("")).cast(id_type).alias("page_id"),
        F.nullif(F.regexp_extract(text, "\\r\\nWARC-Target-URI: ([^\\r]*)\\r\\n", 1), F.lit("")).alias("url"), "payload")
