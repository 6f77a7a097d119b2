"""WARC archives with revisit resolution.

Headers (id, URL, digest, length) are shuffled by payload digest; of records with equal
payloads the one with the least page id is written in full, the others as revisit records
that point to it. Archives are written by Spark's text writer, one record a row with two
line ends as separator, and compressed; reading goes by the lengths in the headers.
"""

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import functions as F

from candlemill.llm.common import staged
from candlemill.session import scratch_path

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 100
#: Records of one archive file; a reading task holds a few files.
FILE_RECORDS = 1_000
#: Characters of payload read back at once.
BATCH_CHARS = 1 << 24
DATE = "2024-01-01T00:00:00Z"

_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(page_id):
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _field(name, value):
    """A header line; left out where the value is NULL. Line ends inside are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_END)), F.lit(""))


def decisions(pages, least=LEAST_BYTES):
    """``(page_id, digest, bytes, first_id, first_url)`` per distinct page id and payload.

    ``first_id`` and ``first_url`` are of the record a revisit refers to; NULL for records
    that are written in full. Only headers are shuffled.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    headers = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    named = headers.filter((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    firsts = staged(
        named.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "firsts",
    )
    # A digest shared by very many pages is one row here, and Spark can split the other side.
    joined = headers.select("page_id", "digest", "bytes").distinct().join(firsts, "digest", "left")
    again = (F.col("bytes") >= least) & F.col("page_id").isNotNull() & (F.col("first.page_id") != F.col("page_id"))
    return joined.select(
        "page_id",
        "digest",
        "bytes",
        F.when(again, F.col("first.page_id")).alias("first_id"),
        F.when(again, F.col("first.url")).alias("first_url"),
    )


def records(pages, least=LEAST_BYTES):
    """The text of one WARC record per page."""
    chosen = staged(decisions(pages, least), "decisions")
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html")
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    same = full["page_id"].eqNullSafe(chosen["page_id"]) & (full["digest"] == chosen["digest"])
    # Decisions are short, so they are what is held in memory; pages stream past, unsorted.
    rows = full.join(chosen.hint("shuffle_hash"), same).select(full["page_id"], "url", "html", full["digest"], "bytes", "first_id", "first_url")
    revisit = F.col("first_id").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_END * 2),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    refers = lambda value: F.when(revisit, value)
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _uri(F.col("page_id"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Profile", refers(F.lit(_PROFILE))),
        _field("WARC-Refers-To", refers(_uri(F.col("first_id")))),
        _field("WARC-Refers-To-Target-URI", refers(F.col("first_url"))),
        _field("WARC-Refers-To-Date", refers(F.lit(DATE))),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_END),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages, path, least=LEAST_BYTES):
    """Writes deduplicated archives below ``path``; a failed task leaves nothing behind.

    * NULL html is an empty payload, NULL url is left out, NULL ``page_id`` an empty id; such
      a record is always written in full and never referred to.
    * Rows equal in id and payload are written alike, each as its own record.
    """
    writer = records(pages, least).write.option("lineSep", _END * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload", pa.string()),
        ("intact", pa.bool_()),
    ]
)
_RECORD_TYPE = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, payload string, intact boolean"
)


def _fields(stream):
    """Header fields up to the empty line, in lower case."""
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _page_of(uri):
    digits = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def _parse(content, payloads):
    """Records of one archive file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(content)))
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = _fields(stream)
        block = io.BytesIO(stream.read(int(fields["content-length"])))
        block.readline()
        http = _fields(block)
        payload = block.read()
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
        size = int(http["content-length"])
        whole = kind == "response"
        yield {
            "page_id": _page_of(fields["warc-record-id"]),
            "url": fields.get("warc-target-uri"),
            "record_type": kind,
            # A full record tells its own digest and length, whatever its header says.
            "payload_digest": hashlib.sha256(payload).hexdigest() if whole else digest,
            "payload_bytes": len(payload) if whole else size,
            "refers_to": _page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
            "payload": payload.decode("utf-8") if whole and payloads else None,
            "intact": not whole or (size == len(payload) and digest == hashlib.sha256(payload).hexdigest()),
        }


def read_archives(spark, path, payloads=True):
    """A row per record; ``payload`` is NULL for revisits, ``intact`` checks full records."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for record in _parse(content.as_buffer(), payloads):
                    rows.append(record)
                    held += len(record["payload"] or "")
                    if len(rows) == 500 or held >= BATCH_CHARS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _RECORD_TYPE)


def restored(archive):
    """The records with the payloads of revisits fetched from the records they refer to."""
    originals = archive.filter("record_type = 'response' AND page_id IS NOT NULL").select(
        F.col("page_id").alias("original"), F.col("payload_digest").alias("its_digest"), F.col("payload").alias("found")
    ).dropDuplicates(["original", "its_digest"])
    same = (F.col("refers_to") == F.col("original")) & (F.col("payload_digest") == F.col("its_digest"))
    joined = archive.join(originals, same, "left")
    return joined.withColumn("payload", F.coalesce("payload", "found")).drop("original", "its_digest", "found")


def archived(pages, least=LEAST_BYTES):
    """Writes the archives to the shared folder and reads their records back.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to, url, intact)``,
    a row per page. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "intact"
    )
