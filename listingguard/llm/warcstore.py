"""A content-addressed web archive.

``write`` stores two tables under one folder: ``payloads``, where equal payload bytes lie once under their SHA-256 address,
and ``records``, the exact header block of every record with the address of its payload. ``read`` joins the two and gives
the original records back byte by byte; each payload is verified against both its address and the SHA-1 of its record.

Defined cases: a null html is the empty payload; a null url leaves its header line out; control characters in a url are
percent-encoded, so that no value can end a header line early. Repeated rows (same id, same payload) are one record each,
and all of them are responses if their id is the largest. A null page_id never wins while another id is there.
An empty table gives an empty archive. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads shorter than this are never replaced by a revisit record.
MIN_REVISIT_BYTES = 1000
DATE = "2026-01-01T00:00:00Z"
CRLF = "\r\n"


def record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("null"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def header(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def describe(pages: DataFrame, date: str = DATE) -> DataFrame:
    """A row per record without its payload: page_id, address, sha1, payload_bytes, record_type, refers_to, header."""
    base = addressed(pages).drop("payload")
    winners = (
        base.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("address")
        .agg(F.max("page_id").alias("largest"))
    )
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    revisit = ~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull()
    target = F.when(F.col("revisit"), F.col("largest"))
    kind = F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    lines = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", record_id(F.col("page_id"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", url),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        header("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("WARC-Refers-To", F.when(F.col("revisit"), record_id(F.col("refers_to")))),
        header("Content-Type", F.lit("text/html")),
        header("Content-Length", F.when(F.col("revisit"), F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF),
    )
    return (
        base.join(winners, "address", "left")
        .withColumn("revisit", revisit)
        .withColumn("refers_to", target)
        .withColumn("record_type", kind)
        .withColumn("header", lines)
        .select("page_id", "address", "payload_bytes", "refers_to", "header")
    )


def addressed(pages: DataFrame) -> DataFrame:
    return (
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
        .withColumn("address", F.unhex(F.sha2("payload", 256)))
        .withColumn("sha1", F.sha1("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    )


def write(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write the archive's two tables below ``path``."""
    payloads = addressed(pages).groupBy("address").agg(F.first("payload").alias("payload"))
    payloads.write.parquet(f"{path}/payloads")
    describe(pages, date).write.parquet(f"{path}/records")


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload (the full one, for revisits too) and record (the bytes as they stand in a WARC file).

    A payload whose bytes do not have the address they lie under, or not the digest in the record's header, is an error.
    """
    payload = F.col("payload")
    said = F.regexp_extract("header", r"WARC-Payload-Digest: sha1:([0-9a-f]{40})", 1)
    sound = (F.unhex(F.sha2(payload, 256)) == F.col("address")) & (F.sha1(payload) == said)
    checked = F.when(sound, payload).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.hex("address"))))
    block = F.when(F.col("refers_to").isNull(), payload).otherwise(F.lit(b""))
    stored = spark.read.parquet(f"{path}/payloads")
    return (
        spark.read.parquet(f"{path}/records")
        .join(stored, "address", "left")
        .withColumn("payload", checked)
        .withColumn("record", F.concat(F.col("header").cast("binary"), block, F.lit(f"{CRLF}{CRLF}".encode())))
        .select("page_id", "refers_to", "header", "payload", "record")
    )


def summary(archive: DataFrame) -> DataFrame:
    """What the records say, parsed from their header bytes, and the size of the payload that was read."""
    return archive.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_extract("header", r"WARC-Payload-Digest: sha1:([0-9a-f]{40})", 1).alias("payload_digest"),
        F.regexp_extract("header", r"WARC-Type: (\w+)", 1).alias("record_type"),
        "refers_to",
    )
