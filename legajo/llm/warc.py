"""A content-addressed WARC archive: headers of every record, each payload once.

Records are WARC/1.1. Those with equal payloads are one response, the record with the largest id, and revisits that refer
to it. The archive is two tables: ``headers`` with the exact header block of each record and the address of its payload, and ``payloads`` with the bytes,
once per address. The address is SHA-256; that equal addresses mean equal bytes is verified when payloads are stored, by length and a
second hash of another kind, and again when they are read. Original records come back by a join.

Copies are reduced by aggregates that combine where they are read, so a payload shared by a third of all records is one
row per task. Payload bytes are shuffled once, in storing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
#: The HTTP header block in front of a payload.
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=UTF-8" + CRLF + CRLF
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexes: Column) -> Column:
    """Base32 of 40 hexadecimal digits: ten at a time are eight digits to base 32."""
    parts = [F.lpad(F.conv(F.substring(hexes, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), HEX32, BASE32)


def _record_id(record: Column) -> Column:
    """A urn that is the same whenever the same record is written."""
    digits = F.md5(F.concat(F.lit("record-"), F.coalesce(record.cast("string"), F.lit(""))))
    cuts = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _number(record: Column) -> Column:
    return F.coalesce(record.cast("string"), F.lit(""))


def archive(pages: DataFrame, folder: str, record: str = "page_id", url: str = "url", html: str = "html", date: str = "2000-01-01T00:00:00Z") -> None:
    """Write ``headers`` and ``payloads`` below ``folder``.

    A null payload is empty and a null url is left empty; line breaks in a url, which would end its header, are percent-encoded. Equal payloads of any length, the empty one
    included, share one response. Rows of the same largest id are each a response; a row without an id is a revisit where its payload has a row with an id, else a response.
    """
    spark = pages.sparkSession
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(record).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"))
    address = F.sha2("body", 256)
    stored = rows.select("id", "body", address.alias("address"), F.xxhash64("body").alias("check"), F.octet_length("body").alias("bytes"))
    stored = stored.groupBy("address").agg(
        F.max("id").alias("response"), F.first("body").alias("payload"),
        F.min("check").alias("low"), F.max("check").alias("high"), F.min("bytes").alias("bytes"), F.max("bytes").alias("most"),
    )
    same = (F.col("low") == F.col("high")) & (F.col("bytes") == F.col("most"))
    stored = stored.withColumn("address", F.when(same, F.col("address")).otherwise(F.raise_error(F.lit("two payloads of one digest"))))
    stored = stored.select("address", "response", F.col("bytes").cast("long").alias("bytes"), base32(F.sha1("payload")).alias("sha1"), "payload")
    stored.write.parquet(f"{folder}/payloads")
    payloads = spark.read.schema(stored.schema).parquet(f"{folder}/payloads").drop("payload")

    heads = rows.select("id", "url", address.alias("address")).join(payloads, "address")
    first = F.coalesce(F.col("id") == F.col("response"), F.col("response").isNull())
    target = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(first, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(~first, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response")))),
        F.when(~first, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("X-Record-Number: "), _number(F.col("id"))),
        F.when(~first, F.concat(F.lit("X-Refers-To-Number: "), _number(F.col("response")))),
        F.concat(F.lit("Content-Length: "), F.when(first, F.col("bytes") + len(HTTP)).otherwise(len(HTTP)).cast("string")),
    ]
    header = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF + HTTP))
    heads.select(F.encode(header, "UTF-8").alias("header"), "address").write.parquet(f"{folder}/headers")


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: header, address, record id, type, target and what it refers to, from the header's bytes."""
    heads = spark.read.schema("header binary, address string").parquet(f"{folder}/headers")
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    number = lambda name: F.expr(f"try_cast(regexp_extract(decode(header, 'UTF-8'), '\\r\\n{name}: ([^\\r]*)\\r\\n', 1) as bigint)")
    return heads.select(
        number("X-Record-Number").alias("id"), field("WARC-Type").alias("record_type"), field("WARC-Target-URI").alias("url"),
        number("X-Refers-To-Number").alias("refers_to"), field("WARC-Payload-Digest").alias("digest"), "header", "address",
    )


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """address, payload, its length and base32 SHA-1; a payload that does not match its address is an error."""
    rows = spark.read.schema("address string, payload binary").parquet(f"{folder}/payloads")
    whole = F.sha2("payload", 256) == F.col("address")
    payload = F.when(whole, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    rows = rows.select("address", payload.alias("payload"))
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32(F.sha1("payload"))})


def records(spark: SparkSession, folder: str, revisits_whole: bool = False) -> DataFrame:
    """Original records: id and their exact bytes, a revisit with its header block alone unless ``revisits_whole``."""
    rows = read_headers(spark, folder).join(read_payloads(spark, folder), "address")
    body = F.col("payload") if revisits_whole else F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return rows.select("id", "record_type", F.concat("header", body, F.lit((CRLF + CRLF).encode())).alias("record"))
