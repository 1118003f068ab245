"""WARC archives: written from captures, read back, and assembled to transactions.

Archives are written by Spark's text writer: one value is one record (header block,
blank line, content) and the line separator is the two line ends that close a WARC
record, so each gzip part file is a WARC file, committed by Spark and read back with
Spark, wherever the folder lies.  A capture becomes three records: the response (or a
revisit of an earlier response with the same payload), the request and a metadata
record, the latter two naming the first in WARC-Concurrent-To.  ``assemble`` joins them
through that identifier and emits one nested row per capture.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidentpanel.llm.common import pinned, stored
from incidentpanel.session import scratch_path

# Payloads shorter than this are stored every time.
REVISIT_BYTES = 100
# Payload bytes of an archive file, about: a reader holds one file at a time.
FILE_BYTES = 16 << 20
MAX_BYTES_PER_RECORD_BATCH = 8 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The format needs a date; captures of a table without one all carry this.
NO_DATE = "1970-01-01T00:00:00Z"


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise(F.lit(""))


def _record(kind: Column, record_id: Column, content_type: str, block: Column, *extra: Column) -> Column:
    """One record as text; the writer adds the closing line ends."""
    return F.concat(
        F.lit(VERSION + END),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", record_id),
        _field("WARC-Date", F.lit(NO_DATE)),
        *extra,
        _field("Content-Type", F.lit(content_type)),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def _uri(url: Column) -> Column:
    """White space and control characters would end a header line: percent-encode them."""
    plain = F.regexp_replace(url, "[^\x21-\x7e\u0080-\U0010ffff]", "_")
    return F.when(url == plain, url).otherwise(F.concat(F.lit("urn:escaped:"), F.url_encode(url)))


def _named(digest: Column, *parts: Column) -> Column:
    """A record id in URN form from a hash of the capture's parts."""
    h = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in (digest, *parts)]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def roles(slim: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """What is special about a (page id, payload): it repeats an earlier page's, or its row is repeated.

    ``refers_to`` is the smallest page id with the same long payload (null for that page
    itself), ``repeated`` tells rows given more than once, ``first_repeated`` that of the
    page referred to.  A hot payload is one row after the partial aggregate.
    """
    pages = slim.groupBy("page_id", "digest", "bytes").agg(F.count("*").alias("n"))
    shared = (
        pages.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.min_by("n", "page_id").alias("first_n"), F.count("*").alias("pages"))
        .where("pages > 1")
    )
    joined = pages.join(shared, "digest", "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.where(other | (F.col("n") > 1)).select(
        F.col("page_id").alias("__page"),
        F.col("digest").alias("__digest"),
        F.when(other, F.col("first")).alias("refers_to"),
        (F.col("n") > 1).alias("repeated"),
        (F.col("first_n") > 1).alias("first_repeated"),
    )


def write(pages: DataFrame, path: str, least_bytes: int = REVISIT_BYTES) -> None:
    """Write the captures (page_id, url, html) as gzip WARC files below ``path``."""
    payload = F.coalesce("html", F.lit(""))
    captures = pages.select("page_id", "url", payload.alias("html")).withColumns(
        {"digest": F.sha2("html", 256), "bytes": F.octet_length("html").cast("long")}
    )
    slim = pinned(captures.select("page_id", "digest", "bytes"))
    mean = slim.agg(F.avg("bytes")).first()[0] or 0
    known = roles(slim, least_bytes)
    rows = captures.join(
        known, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest")), "left"
    ).withColumn("copy", F.monotonically_increasing_id())
    again = F.col("refers_to").isNotNull()
    # Ids follow from page id and payload, so a revisit can name the response it repeats;
    # rows given more than once are told apart, and nothing refers to them by id.
    copy = F.when(F.col("repeated"), F.col("copy"))
    ids = _named(F.col("digest"), F.col("page_id"), copy)
    first = F.when(again & ~F.col("first_repeated"), _named(F.col("digest"), F.col("refers_to"), F.lit(None).cast("long")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    shared = [
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
    ]
    response = _record(
        F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response")),
        F.col("id"),
        "application/http; msgtype=response",
        F.concat("http", F.when(F.col("again"), F.lit("")).otherwise(F.col("html"))),
        *shared,
        _field("WARC-Refers-To", F.col("first")),
        _field("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
    )
    beside = _field("WARC-Concurrent-To", F.col("id"))
    request = _record(
        F.lit("request"),
        _named(F.col("id"), F.lit("request")),
        "application/http; msgtype=request",
        F.concat(F.lit("GET "), F.coalesce("uri", F.lit("*")), F.lit(f" HTTP/1.1{END}{END}")),
        beside,
        _field("WARC-Target-URI", F.col("uri")),
    )
    metadata = _record(
        F.lit("metadata"),
        _named(F.col("id"), F.lit("metadata")),
        "application/warc-fields",
        F.concat(_field("page-id", F.col("page_id").cast("string")), _field("refers-to-page", F.col("refers_to").cast("string"))),
        beside,
    )
    named = rows.select("*", ids.alias("id"), first.alias("first"), again.alias("again"), _uri(F.col("url")).alias("uri"), http.alias("http"))
    # The three records of a capture go to the same file.
    named.select(F.explode(F.array(response, request, metadata)).alias("value")).write.option("lineSep", END * 2).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", 3 * max(1, int(FILE_BYTES / (mean + 1000)))).text(path)


RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("record_type", "record_id", "concurrent_to", "refers_to", "target_uri", "stated_digest", "fields")]
    + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType())]
)


def _parse(data: memoryview, with_payload: bool) -> Iterator[dict]:
    """Records of one file, by their stated lengths."""
    at = 0
    whole = bytes(data)
    while at < len(whole):
        stop = whole.find(b"\r\n\r\n", at)
        if stop < 0 or not whole.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = whole[at:stop].decode("utf-8").split(END)[1:]
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        begin = stop + 4
        end = begin + int(head["content-length"])
        block = data[begin:end]
        kind = head["warc-type"]
        row = dict.fromkeys(RECORD.names)
        row |= {
            "record_type": kind,
            "record_id": head["warc-record-id"],
            "concurrent_to": head.get("warc-concurrent-to"),
            "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"),
            "stated_digest": (head.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
        }
        if kind in ("response", "revisit"):
            cut = whole.find(b"\r\n\r\n", begin, end) + 4
            http = whole[begin:cut].decode("latin-1").split(END)
            sizes = [int(x.partition(":")[2]) for x in http if x.lower().startswith("content-length:")]
            if kind == "revisit":
                row |= {"payload_bytes": sizes[0] if sizes else None, "payload_digest": row["stated_digest"]}
            else:
                body = data[cut:end]
                row |= {"payload_bytes": len(body), "payload_digest": hashlib.sha256(body).hexdigest()}
                if with_payload:
                    row["payload"] = bytes(body)
                if row["stated_digest"] not in (None, row["payload_digest"]):
                    raise ValueError(f"payload of {row['record_id']} does not match its digest")
        elif kind == "metadata":
            row["fields"] = bytes(block).decode("utf-8")
        yield row
        at = end + 4


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below ``path``, one row each.

    Response payloads are digested and checked against the stated digest; the bytes
    themselves are returned unless ``with_payload`` is false.
    """
    schema = pa.schema(
        [pa.field(n, pa.string()) for n in RECORD.names[:7]]
        + [pa.field("payload_bytes", pa.int64()), pa.field("payload_digest", pa.string()), pa.field("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for k in range(len(batch)):
                content = batch.column("content")[k].as_buffer().to_pybytes()
                if content[:2] == b"\x1f\x8b":
                    # Members follow each other when records are packed one by one.
                    parts = []
                    while content:
                        member = zlib.decompressobj(31)
                        parts.append(member.decompress(content))
                        content = member.unused_data
                    content = b"".join(parts)
                rows, held = [], 0
                for row in _parse(memoryview(content), with_payload):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > MAX_BYTES_PER_RECORD_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response, request and metadata structs.

    Requests and metadata find their capture through concurrent_to; a part that is
    missing is null, and parts that name no known capture stay as rows of their own.
    """
    main = records.where(F.col("record_type").isin("response", "revisit"))
    response = main.select(
        F.col("record_id").alias("capture_id"),
        F.struct("record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest", "payload").alias("response"),
    )
    request = records.where(F.col("record_type") == "request").select(
        F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target_uri").alias("request")
    )
    metadata = records.where(F.col("record_type") == "metadata").select(
        F.col("concurrent_to").alias("capture_id"),
        F.struct("record_id", F.str_to_map("fields", F.lit(END), F.lit(": ")).alias("fields")).alias("metadata"),
    )
    return response.join(request, "capture_id", "full").join(metadata, "capture_id", "full")


def round_trip(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write archives of all pages to the shared folder, read them back and assemble them.

    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``, one row per
    input row.  Null html is an empty payload; null urls leave the target out; a null
    page id comes back null and is never referred to while its group has another;
    rows repeating an id with the same payload count as the same capture's response;
    an empty table gives an empty archive; other columns are not written.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages.select("page_id", "url", "html"), path, least_bytes)
    # Parsed once; the assembly reads the records three times.
    captures = assemble(stored(read(spark, path, with_payload=False), "warc-records"))
    fields = F.col("metadata.fields")
    return captures.select(
        fields["page-id"].cast("long").alias("page_id"),
        "response.payload_bytes",
        "response.payload_digest",
        "response.record_type",
        fields["refers-to-page"].cast("long").alias("refers_to"),
    )
