"""WARC archives of web captures, written and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.sources.shared import as_table, shared_folder

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("record_id", "record_type", "concurrent_to", "refers_to", "target_uri", "payload_digest", "fields")
    ]
    + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def base32_sha1(payload: Column) -> Column:
    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: base64.b32encode(hashlib.sha1(x.encode()).digest()).decode())

    return F.pandas_udf(digest, "string")(payload)


def _record_id(kind: str, row: str = "row", page_id: str = "page_id") -> Column:
    """A urn of the kind of record, the page and the number of its row."""
    named = F.concat_ws("|", F.lit(kind), F.col(page_id).cast("string"), F.col(row).cast("string"))
    return F.regexp_replace(
        F.md5(named), "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>"
    )


def _record(kind: Column | str, record_id: Column, content_type: str, headers: list[Column], block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {DATE}"), *headers, F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *head), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = 30_000) -> None:
    """Writes a request, a response or revisit, and a metadata record for each page.

    ``pages`` has ``page_id``, ``url`` and ``html``.  Of the pages whose equal payload has at least
    ``min_bytes`` bytes, the one with the largest id is the response; the others are revisits,
    which hold no payload and refer to it.  The request and the metadata name the response or
    revisit as concurrent.  Files are compressed and hold ``records_per_file`` records at most.

    A null html is an empty payload.  A null url is left out; tabs, line ends and
    spaces in one are percent-encoded.  Null ids come before all others; of repeated largest ids, one row
    is the response.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    staged = f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-pages-{uuid.uuid4().hex}"
    pages.select(
        "page_id", "url", text.alias("html"), F.monotonically_increasing_id().alias("row"),
        base32_sha1(text).alias("digest"),
    ).write.option("compression", "zstd").parquet(staged)
    rows = pages.sparkSession.read.parquet(staged)
    first = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "row")).alias("kept"))
        .select("digest", F.struct(F.col("kept.page_id").alias("page_id"), F.col("kept.row").alias("row")).alias("kept"))
    )
    joined = rows.join(first, "digest", "left")
    again = F.coalesce(F.col("kept.row") != F.col("row"), F.lit(False))
    escaped = F.col("url")
    for code in (9, 10, 13, 32):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    target = F.concat(F.lit("WARC-Target-URI: "), escaped)
    main_id = _record_id("main")
    kept_id = _record_id("main", "kept.row", "kept.page_id")
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), main_id)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"), F.lit(CRLF * 2),
    )
    refers = F.when(again, F.concat(F.lit("WARC-Refers-To: "), kept_id))
    profile = F.when(again, F.lit(f"WARC-Profile: {PROFILE}"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    after_host = F.regexp_extract(F.coalesce(escaped, F.lit("")), "://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract(F.coalesce(escaped, F.lit("")), "://([^/?#]*)", 1)
    request = F.concat(
        F.lit("GET "), F.when(after_host.startswith("/"), after_host).otherwise(F.concat(F.lit("/"), after_host)),
        F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF * 2),
    )
    about = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit(""))
    records = F.array(
        _record("request", _record_id("request"), "application/http;msgtype=request", [target, concurrent], request),
        _record(
            F.when(again, F.lit("revisit")).otherwise(F.lit("response")), main_id, "application/http;msgtype=response",
            [target, digest, refers, profile],
            F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html"))),
        ),
        _record("metadata", _record_id("metadata"), "application/warc-fields", [target, concurrent], about),
    )
    (
        joined.select(F.explode(records).alias("value"))
        .write.option("lineSep", CRLF * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def parse(archive: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with names in lower case, and block of each record, one at a time."""
    while line := archive.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError("not at the start of a WARC record")
            continue
        headers = {}
        while (line := archive.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = archive.read(length)
        if len(block) != length:
            raise ValueError("a WARC record ends early")
        yield headers, block


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record; digests and sizes are those of the payload read, where there is one.

    Files are opened by Spark and read record by record.  Without ``payloads`` the
    bytes themselves are left out.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    kind, payload, digest = headers["warc-type"], None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    elif kind == "revisit":
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    rows.append(
                        (
                            headers["warc-record-id"], kind, headers.get("warc-concurrent-to"),
                            headers.get("warc-refers-to"), headers.get("warc-target-uri"), digest,
                            None if kind in ("response", "revisit") else block.decode(),
                            None if payload is None else len(payload), payload if payloads else None,
                        )
                    )
                    size += len(block)
                    if size > 8 << 20:
                        yield table(rows)
                        rows, size = [], 0
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string()] * 7 + [pa.int64(), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.record_batch(columns, RECORD.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(read, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: ``record_id``, ``capture``, ``request``, ``metadata``, ``original``.

    Request and metadata records are joined to the record they name as concurrent; of several, the
    one with the smallest identifier counts.  ``original`` is the capture a revisit refers to, with
    its size and metadata.  A response many revisits refer to is on the side with one row a
    key, so Spark can split the other.
    """

    def concurrent(kind: str) -> DataFrame:
        body = F.struct("record_id", "fields").alias(kind)
        return (
            records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
            .select(F.col("concurrent_to").alias("record_id"), body)
            .groupBy("record_id").agg(F.min(kind).alias(kind))
        )

    main = records.where(F.col("record_type").isin("response", "revisit")).select(
        "record_id", "refers_to",
        F.struct("record_type", "target_uri", "payload_digest", "payload_bytes", "payload").alias("capture"),
    )
    whole = as_table(
        main.join(concurrent("request"), "record_id", "left").join(concurrent("metadata"), "record_id", "left"),
        "warc-captures",
    )
    original = whole.where("capture.record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.struct("record_id", F.col("capture.payload_bytes").alias("payload_bytes"), "metadata").alias("original"),
    )
    return whole.join(original, "refers_to", "left").select("record_id", "capture", "request", "metadata", "original")
