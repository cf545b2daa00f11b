"""Content-addressed web archive.

An archive is two tables. ``payloads`` holds each distinct payload once, under its SHA-256;
``headers`` holds the exact header text of every record with the address of its payload. A record
is rebuilt by joining the two. Digests are verified on the way in (rows under one address must
agree in length and SHA-1) and on the way out (payloads are hashed again); a mismatch fails the
job.

Of the records with equal payloads of at least ``min_bytes`` bytes, that with the largest page_id
is a response and the others revisit it; smaller ones are all responses. Null html: empty payload.
Null url: empty; line ends in a url are escaped. Null page_id: below all others, written ``null``. Rows that tie for the largest
page_id are all responses. Empty table: empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_ID = "urn:page:"


def base32(hexadecimal: Column) -> Column:
    """Base32 of a hex digest whose bits are a multiple of 20: five hex digits give four letters."""
    parts = []
    for i in range(8):
        bits = F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            parts.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*parts)


def page_number(column: str = "page_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def header_text() -> Column:
    """The header block of a record: WARC fields, an empty line, HTTP fields, an empty line."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    fields = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: <" + RECORD_ID), page_number(), F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha1")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <" + RECORD_ID), page_number("keeper"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.col("bytes")).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(fields, http)


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write pages (page_id, url, html) as an archive at ``path``, in two jobs.

    Equal payloads meet after each task has merged its own, so a payload that a third of the pages
    share is shuffled once per task. The join that tells a record whether it revisits is of narrow
    rows, both sides plainly shuffled, so adaptive execution can split a common payload's records.
    """
    spark = pages.sparkSession
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", raw.alias("payload")).withColumns(
        {"address": F.sha2("payload", 256), "sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")}
    )
    stored = rows.groupBy("address").agg(
        F.first("payload").alias("payload"), F.max("page_id").alias("keeper"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("_sha1"), F.min("bytes").alias("bytes"), F.max("bytes").alias("_bytes"),
    )
    sound = (F.col("sha1") == F.col("_sha1")) & (F.col("bytes") == F.col("_bytes"))
    checked = F.when(sound, F.col("address")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under "), F.col("address"))))
    stored.select(checked.alias("address"), "sha1", "bytes", "keeper", "payload").write.parquet(f"{path}/payloads")

    keepers = spark.read.parquet(f"{path}/payloads").select("address", "keeper")
    again = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    records = (
        rows.drop("payload").join(keepers, "address")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    )
    records.select("address", header_text().alias("header")).write.parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive: exact header text, payload and whole record as bytes."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = F.sha2("payload", 256) == F.col("address")
    payloads = stored.select("address", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))).alias("payload"))
    ending = F.lit("\r\n\r\n").cast("binary")
    return spark.read.parquet(f"{path}/headers").join(payloads, "address").select(
        "header", "payload", F.concat(F.col("header").cast("binary"), "payload", ending).alias("record")
    )


def parsed(records: DataFrame) -> DataFrame:
    """The fields of each record, read from its header text, with its payload."""
    def number(field: str) -> Column:
        return F.regexp_extract("header", rf"\r\n{field}: <{RECORD_ID}(-?\d+)>", 1).try_cast("long")

    return records.select(
        number("WARC-Record-ID").alias("page_id"),
        F.regexp_extract("header", r"^WARC/1\.1\r\nWARC-Type: (\w+)", 1).alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]{32})\r\n", 1).alias("stated_digest"),
        "payload",
    )
