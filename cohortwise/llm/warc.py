"""WARC archives: writing pages as records, and transaction assembly.

A capture is three records: the request, the response (or a revisit, if an
equal payload is archived as another page's response) and metadata. Request
and metadata name the response in ``WARC-Concurrent-To``. Archives are written
by Spark's text writer, with the record terminator as line separator, and so
work in any store that Spark writes to; every file holds a bounded number of
records. They are read as binary files and cut by ``Content-Length``, never by
searching for a separator. ``captures`` joins the records of a transaction
through their concurrent-to identifiers into one nested row.
"""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.storage import written

#: Payloads of at least so many bytes are archived once and revisited.
REVISIT_FROM = 0
RECORDS_PER_FILE = 6000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes in one batch of parsed records.
BATCH_BYTES = 4 << 20

RECORD_SCHEMA = ("record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
                 "warc_date string, payload_digest string, content_type string, http_header string, payload binary")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: 8 runs of 20 bits."""
    digits = F.sha1(data)
    runs = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*runs), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, capture: Column, nth: Column) -> Column:
    hexes = F.md5(F.concat(F.lit(kind + ":"), F.hex(capture), F.lit(":"), nth.cast("string")).cast("binary"))
    parts = [F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its terminator; headers with a null value are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))).otherwise(F.lit("")) for k, v in headers]
    return F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"),
                    F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Archives every row of ``pages`` under ``path``, three records a row.

    A null payload is empty; a null url or id is left out of the records. Of
    equal payloads of at least ``revisit_from`` bytes the row with the largest
    id is the response (of rows that tie, one), the others revisit it; null
    ids lose. Rows that repeat id, url and payload are captures of their own,
    told apart by a number. An empty table writes an empty archive. Line ends
    in a url are percent-encoded. Other columns are not read.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("html", 256)))
    rows = rows.withColumn("capture", F.unhex(F.md5(F.to_json(F.struct("page_id", "url", F.hex("sha").alias("sha"))))))
    # what is not a response of its own: revisits, and rows that occur more than once; payloads stay out of it
    distinct = rows.select("capture", "sha", "page_id", (F.octet_length("html") >= revisit_from).alias("shared")).groupBy(
        "capture").agg(F.first("sha").alias("sha"), F.first("page_id").alias("page_id"), F.first("shared").alias("shared"),
                       F.count(F.lit(1)).cast("int").alias("copies"))
    winners = distinct.where("shared").groupBy("sha").agg(F.max(F.struct("page_id", "capture")).alias("win"))
    judged = distinct.join(winners, "sha", "left").select(
        "capture", F.when(F.col("shared"), F.col("win.capture")).alias("first"), "copies")
    odd = written(judged.where("first <> capture OR copies > 1"), "revisits")
    tagged = rows.drop("sha").join(odd, "capture", "left")
    once = tagged.where("copies IS NULL OR copies = 1").withColumn("nth", F.lit(1))
    more = tagged.where("copies > 1").dropDuplicates(["capture"]).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    each = once.unionByName(more)
    revisit = F.col("first").isNotNull() & ((F.col("first") != F.col("capture")) | (F.col("nth") > 1))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    own = {k: _record_id(k, F.col("capture"), F.col("nth")) for k in ("request", "capture", "metadata")}
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    common = [("WARC-Target-URI", uri), ("WARC-Date", F.lit(DATE))]
    text = [
        _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", own["request"]), ("WARC-Concurrent-To", own["capture"]),
                 *common, ("Content-Type", F.lit("application/http; msgtype=request"))],
                F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))),
        _record([("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", own["capture"]),
                 ("WARC-Refers-To", F.when(revisit, _record_id("capture", F.col("first"), F.lit(1)))),
                 ("WARC-Profile", F.when(revisit, F.lit(PROFILE))), *common,
                 ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html").cast("binary")))),
                 ("Content-Type", F.lit("application/http; msgtype=response"))],
                F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))),
        _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", own["metadata"]), ("WARC-Concurrent-To", own["capture"]),
                 *common, ("Content-Type", F.lit("application/warc-fields"))],
                F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n"))),
    ]
    each.select(F.explode(F.array(*text)).alias("value")).write.mode("overwrite").option(
        "maxRecordsPerFile", records_per_file).text(path, compression="gzip", lineSep="\r\n\r\n")


def header_text(raw: bytes) -> str:
    """Header bytes as text: UTF-8, or Latin-1 as older servers send it."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _parsed(content: bytes):
    """The records of one archive file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content))
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = header_text(line).partition(":")
            headers[key.lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("truncated WARC record")
        yield headers, block


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; the block of an HTTP
    record is split into its header and the payload."""
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
    kinds = [pa.binary() if x.endswith("binary") else pa.string() for x in RECORD_SCHEMA.split(", ")]

    def run(batches):
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for files in batches:
            for content in files.column(0):
                for h, block in _parsed(content.as_py()):
                    header, payload = None, block
                    if h.get("content-type", "").startswith("application/http"):
                        header, _, payload = block.partition(b"\r\n\r\n")
                        header = header_text(header)
                    digest = h.get("warc-payload-digest")
                    rows.append((h.get("warc-record-id"), h.get("warc-type"), h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                                 h.get("warc-target-uri"), h.get("warc-date"), digest and digest.removeprefix("sha1:"),
                                 h.get("content-type"), header, payload))
                    size += len(payload)
                    if size >= BATCH_BYTES or len(rows) >= 4096:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id`` and the structs ``request``,
    ``response`` (also of type revisit) and ``metadata``; a struct is null if
    the archives lack the record. Records repeated under one id count once."""
    fields = ["record_id", "record_type", "refers_to", "target_uri", "warc_date", "payload_digest", "http_header", "payload"]
    kind = F.col("record_type")

    def part(*kinds):
        return F.first(F.when(kind.isin(*kinds), F.struct(*fields)), ignorenulls=True)

    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        part("request").alias("request"), part("response", "revisit").alias("response"), part("metadata").alias("metadata"))
