"""Content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; the exact header bytes of every record
are kept in a table of their own; a join of both gives back the original records, byte for
byte. A digest is verified when a payload is read: stored bytes that no longer hash to
their address fail the job. All of it is built-in functions.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinstrata.session import own_folder
from coinstrata.sources.tables import write_table

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are 32 digits of five bits, in four parts
    that fit a long."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.upper(F.concat(*parts)), BASE32_HEX, BASE32)


@dataclass(frozen=True)
class Archive:
    """``payloads`` (sha256, payload) and ``records`` (record_no, sha256, header); a record
    without a stored payload (a revisit) has an empty block."""

    folder: str

    @property
    def payloads(self) -> str:
        return f"{self.folder}/payloads"

    @property
    def records(self) -> str:
        return f"{self.folder}/records"


def web_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Record headers (record_no, sha256, header) and their contents (sha256, payload), a
    row of each for every row of ``pages``; sha256 is null in headers of revisits.

    The payload is the html in UTF-8; null and empty html are the same empty payload. Of
    records with equal payloads of at least ``least_bytes``, the one with the largest
    page_id is the response and the others revisit it; smaller ones are all responses. A
    null id is smaller than any other, and rows that repeat an id are told apart by url,
    so that exactly one row is the response; rows equal in every one of these share that
    role. A null url is written as an empty target.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    contents = pages.select(F.sha2(payload, 256).alias("sha256"), payload.alias("payload"))
    base = pages.select(
        F.col(page_id).cast("long").alias("record_no"),
        F.col(url).cast("string").alias("url"),
        F.sha2(payload, 256).alias("sha256"),
        base32_sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    order = F.struct("record_no", "url")
    newest = base.groupBy("sha256").agg(F.max(order).alias("newest"))
    joined = base.join(newest, "sha256").withColumn(
        "stored", F.col("newest").eqNullSafe(order) | (F.col("payload_bytes") < least_bytes)
    )
    headers = joined.select(
        "record_no",
        F.when(F.col("stored"), F.col("sha256")).alias("sha256"),
        _header().cast("binary").alias("header"),
    )
    return headers, contents


def _header() -> Column:
    """The header block, up to and with the empty line."""
    number = F.coalesce(F.col("record_no").cast("string"), F.lit(""))
    revisited = F.coalesce(F.col("newest.record_no").cast("string"), F.lit(""))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")
    kind = F.when(F.col("stored"), "response").otherwise("revisit")
    block_bytes = F.when(F.col("stored"), F.col("payload_bytes")).otherwise(0)
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), number, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(
            ~F.col("stored"), F.concat(F.lit("WARC-Refers-To: <urn:page:"), revisited, F.lit(">"))
        ),
        F.when(~F.col("stored"), F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), block_bytes),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(headers: DataFrame, contents: DataFrame, folder: str) -> Archive:
    """Write headers (record_no, sha256, header) and contents (sha256, payload). Contents
    of one digest are equal, so one of them is kept, chosen in the map tasks already; a
    payload that does not hash to its digest fails the job."""
    archive = Archive(folder)
    write_table(headers.select("record_no", "sha256", "header"), archive.records)
    wrong = F.raise_error(F.concat(F.lit("payload does not match digest "), F.col("sha256")))
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        wrong.cast("binary")
    )
    once = contents.groupBy("sha256").agg(F.first("payload").alias("payload"))
    write_table(once.select("sha256", checked.alias("payload")), archive.payloads)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """(record_no, header, block, record): the original records; ``record`` is the exact
    bytes of a WARC record with its two closing line ends."""
    headers = spark.read.parquet(archive.records)
    payloads = spark.read.parquet(archive.payloads).select("sha256", "payload")
    joined = headers.join(payloads, "sha256", "left")
    lost = F.raise_error(F.concat(F.lit("no payload for digest "), F.col("sha256")))
    block = (
        F.when(F.col("sha256").isNull(), F.lit(b""))
        .when(F.col("payload").isNull(), lost.cast("binary"))
        .when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"))
        .otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary"))
    )
    return joined.select("record_no", "header", block.alias("block")).withColumn(
        "record", F.concat("header", "block", F.lit(b"\r\n\r\n"))
    )


def header_field(name: str) -> Column:
    """A field of the column ``header``; null if the record hasn't got it."""
    found = F.regexp_extract(F.col("header").cast("string"), f"(?md)^{name}: (.*?)\r$", 1)
    return F.when(found != "", found)


def parsed(records: DataFrame) -> DataFrame:
    """Type, target, digest, length and reference of records, from their header bytes."""
    number = lambda f: F.regexp_extract(header_field(f), "<urn:page:(.*)>", 1)
    return records.select(
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        header_field("WARC-Target-URI").alias("url"),
        header_field("X-Payload-Length").cast("long").alias("payload_bytes"),
        F.regexp_extract(header_field("WARC-Payload-Digest"), "sha1:(.*)", 1).alias(
            "payload_digest"
        ),
        header_field("WARC-Type").alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        F.octet_length("block").cast("long").alias("block_bytes"),
        "block",
    )


def archived_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as an archive below ``folder`` (default: a stage folder), read it
    back and return what the records say, with the digest of a response recomputed from
    the block that was read.

    A null html is an empty payload, and equal payloads of ``least_bytes`` or more, empty
    ones included, have one response. Rows that repeat a page_id are records of their own;
    a null page_id is smaller than all. Very long pages are stored whole, and an empty table
    makes an empty archive."""
    spark = pages.sparkSession
    folder = folder or own_folder(spark, "warc")
    archive = write_archive(*web_records(pages, least_bytes=least_bytes), folder)
    rows = parsed(read_archive(spark, archive))
    response = F.col("record_type") == "response"
    return rows.select(
        "page_id",
        "url",
        F.when(response, F.col("block_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, base32_sha1(F.col("block")))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )
