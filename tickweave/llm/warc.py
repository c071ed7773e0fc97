"""WARC archives without repeated payloads: revisit resolution by payload digest.

Headers are shuffled by digest; of the records with equal payloads one becomes the response and the
others revisits that refer to it. Archives are written and read through Spark's file sources, so any
store works. A part file holds whole records, one after another, compressed as a whole.

Defined cases: a null payload is empty; a null url has no target header, control characters and
spaces in a url are percent-encoded; a null page id sorts last and comes back null; payloads shorter
than ``min_bytes`` are always responses; of repeated rows with the smallest page id one is the
response. Repeated rows are told apart by their place in the input, which has to be a stable source
(files, a table or a checkpoint). An empty table gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of records in one part file, on average; a reader holds one part file at a time.
PART_BYTES = 16 << 20
MIN_REVISIT_BYTES = 100
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = (
    "page_id long, url string, record_id string, record_type string, refers_to_id string, "
    "warc_date string, header_digest string, payload_bytes long, payload_digest string"
)


def resolve_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Each page with its digest, and for a revisit the place and url of the response.

    One row per repeated digest comes from a partial aggregation; the join with the pages is one that
    Spark can split where a digest holds many pages.
    """
    headed = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long")})
    originals = (
        headed.filter(F.col("size") >= min_bytes)
        .groupBy(F.col("digest").alias("same"))
        .agg(
            F.min(F.struct(F.col("page_id").isNull(), "page_id", "place", "url")).alias("original"),
            F.count(F.lit(1)).alias("copies"),
        )
        .filter("copies > 1")
        .drop("copies")
    )
    return headed.join(
        originals, (F.col("digest") == F.col("same")) & (F.col("size") >= min_bytes), "left"
    ).select(
        "page_id", "url", "html", "place", "digest", "size",
        F.when(F.col("original.place") != F.col("place"), F.col("original")).alias("original"),
    )


def _header(name: str, value) -> F.Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _record_id(place, run: str):
    """A version-8 uuid from the archive's name and the record's place."""
    digest = F.sha2(F.concat(F.lit(run), place.cast("string")), 256)
    parts = [
        F.substring(digest, 1, 8), F.substring(digest, 9, 4),
        F.concat(F.lit("8"), F.substring(digest, 14, 3)),
        F.concat(F.lit("a"), F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    ]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _clean_url(url):
    """A url without the bytes that would end a header."""
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), F.regexp_replace(F.url_encode(url), "%2F", "/")).otherwise(url)


def write_archive(
    pages: DataFrame, path: str, warc_date: str, min_bytes: int = MIN_REVISIT_BYTES,
    part_bytes: int = PART_BYTES,
) -> None:
    """Write a record per page below ``path``, payloads once each. ``warc_date`` is an ISO time."""
    run = uuid.uuid4().hex
    resolved = resolve_revisits(pages, min_bytes)
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(_HTTP), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("place"), run)),
        _header("WARC-Date", F.lit(warc_date)),
        _header("WARC-Target-URI", _clean_url(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Profile", F.when(revisit, _PROFILE)),
        _header("WARC-Refers-To", F.when(revisit, _record_id(F.col("original.place"), run))),
        _header("WARC-Refers-To-Target-URI", F.when(revisit, _clean_url(F.col("original.url")))),
        _header("X-Page-Id", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length("body").cast("string")),
        F.lit("\r\n"),
    )
    records = resolved.withColumn("body", body).select(F.concat(headers, F.col("body")).alias("value"))
    total = pages.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("html")).alias("bytes")
    ).first()
    average = max((total["bytes"] or 0) / max(total["rows"], 1), 1) + 600
    (
        records.write.mode("overwrite")
        .option("lineSep", "\r\n\r\n")  # what ends a record
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(int(part_bytes / average), 1))
        .text(path)
    )


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record in turn, by its stated length."""
    at = 0
    while at < len(data):
        if data[at : at + 7] != b"WARC/1.":
            raise ValueError(f"no record at byte {at}")
        stop = data.index(b"\r\n\r\n", at)
        lines = data[data.index(b"\r\n", at) + 2 : stop + 2]
        fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(lines)}
        begin = stop + 4
        end = begin + int(fields["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield fields, data[begin:end]
        at = end + 4


def _stated_length(http: bytes) -> int | None:
    found = re.search(rb"\r\ncontent-length:[ \t]*([0-9]+)", http, re.I)
    return int(found[1]) if found else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _RECORDS.split(", ")]
    kinds = [pa.int64() if n in ("page_id", "payload_bytes") else pa.string() for n in names]
    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            rows = []
            for fields, block in parse_records(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                http, _, payload = block.partition(b"\r\n\r\n")
                response = fields["warc-type"] == "response"
                page = fields.get("x-page-id")
                rows.append((
                    None if page is None else int(page), fields.get("warc-target-uri"),
                    fields["warc-record-id"], fields["warc-type"], fields.get("warc-refers-to"),
                    fields.get("warc-date"),
                    fields.get("warc-payload-digest", "").removeprefix("sha256:"),
                    len(payload) if response else _stated_length(http),
                    hashlib.sha256(payload).hexdigest() if response else None,
                ))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path``; digests are taken from the payloads read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_parsed, _RECORDS)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Pages as archived: a revisit takes length and digest from the response it refers to."""
    records = read_records(spark, path)
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("response_id"),
        F.col("page_id").alias("response_page"),
        F.col("payload_bytes").alias("response_bytes"),
        F.col("payload_digest").alias("response_digest"),
    )
    return records.join(responses, F.col("refers_to_id") == F.col("response_id"), "left").select(
        "page_id", "url", "record_id", "record_type",
        F.coalesce("response_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("response_digest", "payload_digest").alias("payload_digest"),
        F.col("response_page").alias("refers_to"),
    )
