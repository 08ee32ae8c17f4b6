"""Content-addressed WARC archive.

``write_archive`` keeps each distinct payload once, under its SHA-256, and the
exact header bytes of every record apart. ``read_archive`` joins the two again,
checks each payload against its key and gives back the records. Of records with
equal payloads the one with the largest page_id is the ``response``; the others
are ``revisit`` records that name it.

Defined cases: null html is an empty payload; a null url has an empty target; CR
and LF in a url are percent-encoded, as header lines need; a null page_id is the
smallest; of rows equal in page_id, url and payload one stands for the class and
the rest revisit it (the largest url first, if only urls differ); an empty table
gives an empty archive; other columns are not read. A payload that does not
match its key stops the read with an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import utf8

CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_DIGITS_32, RFC4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 bits at a time fit ``conv``."""
    digits = F.sha1(payload)
    return F.translate(
        F.concat(*[F.lpad(F.conv(F.substring(digits, 10 * i + 1, 10), 16, 32), 8, "0")
                   for i in range(4)]),
        HEX_DIGITS_32, RFC4648)


def _urn(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")),
                    F.lit(":"), copy.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                  least_revisit_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as ``path``/payloads (key, payload)
    and ``path``/headers (key, header). Payloads shuffle once, with copies
    removed on the map side; all else is narrow. Payloads shorter than
    ``least_revisit_bytes`` are all responses."""
    raw = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), utf8("html").alias("payload"))
    keyed = raw.withColumn("key", F.sha2("payload", 256))
    (keyed.groupBy("key").agg(F.first("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))

    # equal rows are counted, not gathered, and given out again as copies 1..n
    rows = keyed.select(
        "page_id", "url", "key", F.octet_length("payload").cast("long").alias("n"),
        sha1_base32(F.col("payload")).alias("sha1"),
    ).groupBy("page_id", "url", "key", "n", "sha1").agg(F.count("*").alias("copies"))
    first = rows.groupBy(F.col("key").alias("_key")).agg(F.max(F.struct("page_id", "url")).alias("_top"))
    records = (
        rows.join(first, F.col("key") == F.col("_key"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .withColumn("_is_top", F.struct("page_id", "url").eqNullSafe(F.col("_top")) & (F.col("copy") == 1))
        .withColumn("_response", F.col("_is_top") | (F.col("n") < least_revisit_bytes))
    )
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(F.col("_response"), "response").otherwise("revisit")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("copy"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("_response"), F.lit("")).otherwise(F.concat(
            _line("WARC-Refers-To", _urn(F.col("_top.page_id"), F.lit(1))),
            _line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(F.col("_response"), F.col("n")).otherwise(F.lit(0)).cast("string")),
        F.lit(CRLF),
    )
    (records.select("key", F.encode(header, "UTF-8").alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def _field(header: Column, name: str, pattern: str) -> Column:
    got = F.regexp_extract(header, rf"\r\n{name}: {pattern}\r\n", 1)
    return F.when(got != "", got)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records: page_id, record_type, refers_to, payload_bytes, payload_digest,
    header, payload (the full one, for revisits too) and record (the exact WARC
    record; a revisit's block is empty). Digest and length are taken from the
    stored payload, before the join, so that a query for them alone moves no
    payload; a hot payload's headers are split by Spark's skew join."""
    store = spark.read.schema("key string, payload binary").parquet(f"{path}/payloads")
    # what is read of a payload hangs on its verified bytes, so the check can't be pruned
    sound = F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("key"))).cast("binary"))
    store = store.withColumn("payload", sound).select(
        F.col("key").alias("_key"), "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("payload_digest"))
    heads = spark.read.schema("key string, header binary").parquet(f"{path}/headers")
    text = F.decode("header", "UTF-8")
    heads = heads.select(
        "key", "header",
        _field(text, "WARC-Record-ID", r"<urn:page:([^:>]*):[0-9]+>").try_cast("long").alias("page_id"),
        F.regexp_extract(text, r"\r\nWARC-Type: ([a-z]+)\r\n", 1).alias("record_type"),
        _field(text, "WARC-Refers-To", r"<urn:page:([^:>]*):[0-9]+>").try_cast("long").alias("refers_to"))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return heads.join(store, F.col("key") == F.col("_key")).select(
        "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "header", "payload",
        F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"))
