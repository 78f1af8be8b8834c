"""Operator 10: a content-addressed WARC archive.

An archive is two Parquet tables: ``payloads`` holds each distinct payload once under its SHA-256
and length, ``records`` the exact head of every record (WARC fields and HTTP head, as bytes) with
the key of its payload. A record is its head, its payload where it is a response, and the closing
line ends, so a join gives back the original records byte by byte. Reading digests the stored
payloads again; a payload or head that does not match its digest raises an error.

Of the records with equal payloads of at least ``least`` bytes the one with the largest page_id is
a response and the others revisit it; records of smaller payloads are all responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .base import staged

#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The date written where a page has none of its own.
DATE = "1970-01-01T00:00:00Z"


def base32(hex_digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal digest, four characters for each five digits."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.translate(F.concat(*[
        F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]), digits, ALPHABET)


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _head() -> Column:
    """The bytes of a record before its payload."""
    http = F.concat(F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END + "Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END + END))
    revisit = F.col("record_type") == "revisit"
    content = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    field = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(END))
    return F.encode(F.concat(
        F.lit(VERSION + END), field("WARC-Type", F.col("record_type")), field("WARC-Record-ID", _urn(F.col("page_id"))),
        field("WARC-Date", F.lit(DATE)), field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", _urn(F.col("refers_to")))))
        .otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", content.cast("string")),
        F.lit(END), http), "UTF-8")


def write_archive(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as the archive at ``path``.

    A null html is an empty payload, a null url an empty address. Rows that repeat the largest
    page_id of their payload are all responses; a null page_id is below all others. Other columns
    are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), "url", payload(F.col("html")).alias("payload"))
    rows = rows.withColumn("sha256", F.unhex(F.sha2("payload", 256)))
    facts = rows.select("page_id", "url", "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
                        base32(F.sha1("payload")).alias("payload_digest"))
    keepers = staged(facts.groupBy("sha256", "payload_bytes").agg(F.max("page_id").alias("keeper")), "keepers")
    decided = (facts.join(keepers, ["sha256", "payload_bytes"])
               .withColumn("first", F.col("page_id").eqNullSafe(F.col("keeper")) | (F.col("payload_bytes") < least))
               .withColumn("record_type", F.when(F.col("first"), "response").otherwise("revisit"))
               .withColumn("refers_to", F.when(~F.col("first"), F.col("keeper"))))
    decided.select("page_id", _head().alias("head"), "sha256", "payload_bytes").write.parquet(f"{path}/records")
    # plain keys, as null-safe ones would shuffle the payloads again for the window
    place = lambda c: F.coalesce(F.col(c), F.lit(-(1 << 63)))
    kept = keepers.select("sha256", place("keeper").alias("place"))
    once = Window.partitionBy("place", "sha256").orderBy("sha256")
    (rows.select(place("page_id").alias("place"), "sha256", "payload").join(kept, ["place", "sha256"])
     .withColumn("n", F.row_number().over(once)).where("n = 1")
     .select("sha256", "payload").write.parquet(f"{path}/payloads"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The payloads with what their bytes digest to now."""
    right = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    return (spark.read.parquet(f"{path}/payloads")
            .withColumn("payload", F.when(right, F.col("payload")).otherwise(
                F.raise_error(F.lit("a stored payload does not match its SHA-256")).cast("binary"))))


def _field(name: str) -> Column:
    """A WARC field of the record whose bytes are ``head``; empty where it has none."""
    return F.regexp_extract(F.decode("head", "UTF-8"), rf"\n{name}: ([^\r\n]*)", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, read from
    the heads and from the stored payloads, whose digests must agree."""
    facts = _stored(spark, path).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"))
    page = lambda name: F.expr("try_cast(regexp_extract({0}, '^<urn:page:(-?[0-9]+)>$', 1) AS bigint)".format(name))
    heads = spark.read.parquet(f"{path}/records").select(
        "sha256", _field("WARC-Type").alias("record_type"), _field("WARC-Payload-Digest").alias("said"),
        _field("WARC-Record-ID").alias("id"), _field("WARC-Refers-To").alias("to"))
    agree = F.col("said") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return (heads.join(facts, "sha256")
            .select(page("id").alias("page_id"), "payload_bytes",
                    F.when(agree, F.col("payload_digest")).otherwise(
                        F.raise_error(F.lit("a record's digest does not match its payload")).cast("string")).alias("payload_digest"),
                    "record_type", page("to").alias("refers_to")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record, payload): the original records as bytes, and the full payload each stands for."""
    revisit = _field("WARC-Type") == "revisit"
    return (spark.read.parquet(f"{path}/records").join(_stored(spark, path), "sha256")
            .select("page_id", F.concat("head", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")),
                                        F.lit((END + END).encode())).alias("record"), "payload"))
