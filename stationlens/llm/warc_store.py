"""Content-addressed WARC archive.

``write_archive`` turns pages into two tables in the shared folder: *payloads* holds every
distinct payload once under its digest, *headers* holds the exact header bytes of each
record with the digest of its payload.  ``read_archive`` joins them back to whole records,
checks every payload against the digest in its header, and reads all that it tells of a record from
the record's bytes.  Record ids are unique, also where page ids repeat.

All of it is DataFrame work.  The only rows that carry payloads through a shuffle are one
per distinct payload and task (partial aggregation keeps the first), so copies of one page
meet as single rows however many there are.  The joins carry digests and ids; AQE splits
the partitions of a digest that a large share of the records has.

Defined cases: null html is the empty payload; a null url gives an empty target URI; line
breaks in a url are written as %0D and %0A; pages with a null id are archived as responses (if they are the only ones with their payload) or
revisits that refer to the smallest id that is there; repeated ids each keep a record, and of equal
payloads all rows with the smallest id are responses; an empty table gives empty tables;
columns other than the three are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_AS_RADIX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
#: Fields of this archive beside the standard's: the ids of the page and of the page referred to.
PAGE_FIELD, REFERS_TO_PAGE_FIELD = "X-Page-ID", "X-Refers-To-Page-ID"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), BASE32_AS_RADIX, BASE32)


def record_id(page_id: Column, number: Column) -> Column:
    """A URN of the page's id and of the record's number in the archive."""
    text = F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), number.cast("string"))
    hexed = F.md5(text.cast("binary"))
    cut = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _uri(url: Column) -> Column:
    """``url`` for a header line: line breaks are written in percent form."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _described(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    ).withColumns({
        "content_key": F.sha2("payload", 256),
        "payload_bytes": F.length("payload").cast("long"),
    })


def write_archive(
    pages: DataFrame,
    min_revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> dict[str, str]:
    """Write the two tables; returns their paths by the names ``payloads`` and ``headers``.

    Payloads of at least ``min_revisit_bytes`` are recorded as response once, for the
    smallest page id, and as revisit otherwise.
    """
    spark = pages.sparkSession
    described = _described(pages, id_col, url_col, html_col)
    paths = {name: common.scratch_path(spark, f"warc-{name}") for name in ("payloads", "headers")}

    # A payload is stored once for its SHA-256.  The length and a second hash of every row
    # are compared, so that two payloads under one digest stop the job.
    same = F.xxhash64("payload", "payload_bytes")
    (
        described.groupBy("content_key")
        .agg(F.first("payload").alias("payload"), (F.min(same) == F.max(same)).alias("verified"))
        .withColumn("payload_digest", base32_sha1(F.col("payload")))
        .withColumn(
            "verified",
            F.when(F.col("verified"), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("two payloads under digest "), F.col("content_key")))
            ),
        )
        .write.option("compression", "zstd").parquet(paths["payloads"])
    )
    digests = spark.read.parquet(paths["payloads"]).select("content_key", "payload_digest")

    # Records without their payloads; the number that tells them apart holds from here on.
    numbered, numbered_path = common.stored(
        described.select("page_id", "url", "content_key", "payload_bytes").withColumn("number", F.monotonically_increasing_id()),
        "warc-records",
    )
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "number")))
    firsts = numbered.groupBy("content_key").agg(least.alias("first")).join(digests, "content_key")
    records = numbered.join(firsts, "content_key")
    revisit = (F.col("payload_bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), record_id(F.col("page_id"), F.col("number")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), _uri(F.col("url")),
        F.lit(f"{CRLF}{PAGE_FIELD}: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit(f"{CRLF}WARC-Refers-To: "), record_id(F.col("first.page_id"), F.col("first.number")),
            F.lit(f"{CRLF}{REFERS_TO_PAGE_FIELD}: "), F.col("first.page_id").cast("string"),
            F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        )).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string")),
        F.lit(CRLF + CRLF),
    )
    (
        records.withColumn("header", header.cast("binary")).select("content_key", "header")
        .write.option("compression", "zstd").parquet(paths["headers"])
    )
    common.remove(spark, numbered_path)
    return paths


def rebuilt(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``record``, the exact WARC bytes of every record, and the ``payload`` its digest stands for.

    A payload that does not match its SHA-256, or the digest in its record's header, stops the job.
    """
    headers = spark.read.parquet(paths["headers"])
    payloads = spark.read.parquet(paths["payloads"]).select("content_key", "payload")
    # Digests are taken once for each stored payload, before the join repeats it.
    payloads = payloads.withColumn("payload_digest", F.when(
        F.sha2("payload", 256) == F.col("content_key"), base32_sha1(F.col("payload"))
    ).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("content_key")))))
    in_header = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(CRLF))
    is_response = F.contains(F.col("header"), F.lit(f"{CRLF}WARC-Type: response{CRLF}".encode()))
    checked = F.when(F.contains(F.col("header"), in_header.cast("binary")), F.col("header")).otherwise(
        F.raise_error(F.concat(F.lit("wrong digest in the header "), F.col("header").cast("string"))).cast("binary"))
    body = F.when(is_response, F.col("payload")).otherwise(F.lit(b""))
    return headers.join(payloads, "content_key").select(
        F.concat(checked, body, F.lit((CRLF * 2).encode())).alias("record"), "payload"
    )


def field(record: Column, name: str) -> Column:
    """A field of a record's header; null if it has none of that name."""
    header = F.concat(F.lit(CRLF), F.substring_index(record.cast("string"), CRLF + CRLF, 1), F.lit(CRLF))
    after = F.substring_index(header, f"{CRLF}{name}: ", -1)
    return F.when(F.contains(header, F.lit(f"{CRLF}{name}: ")), F.substring_index(after, CRLF, 1))


def read_archive(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Every record again: ``record``, its exact WARC bytes, ``payload``, payload_bytes, and what its
    header says: page_id, record_type, record_id, refers_to (a page id), payload_digest."""
    record = F.col("record")
    return rebuilt(spark, paths).select(
        field(record, PAGE_FIELD).try_cast("long").alias("page_id"),
        field(record, "WARC-Type").alias("record_type"),
        field(record, "WARC-Record-ID").alias("record_id"),
        field(record, REFERS_TO_PAGE_FIELD).cast("long").alias("refers_to"),
        F.substring_index(field(record, "WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.length("record").cast("long").alias("record_bytes"),
        "payload", "record",
    )
