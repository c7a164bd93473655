"""WARC archives of pages, and assembly of their transactions.

A capture is three records: request, response (or revisit, if an equal payload is stored already)
and metadata; request and metadata name the capture's main record in WARC-Concurrent-To. Archives
are written and read by Spark's own file sources, so any store that Spark reaches will do. Reading
parses records by their Content-Length; records are then joined by these identifiers, in whichever
files they are, to one nested row per capture.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarframe.llm.common import materialise, new_path, table, with_row_keys

MIN_REVISIT_BYTES = 1000
# Captures of an archive by the size of their payloads, so that archives stay near 64 MB before packing (or
# hold one capture): (payloads below so many bytes, captures).
ARCHIVES = ((1 << 16, 1000), (1 << 22, 16), (None, 1))
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def _record_id(kind: str) -> Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), "page_id", "row_file", "row_at", F.sha1(F.coalesce("url", F.lit("")))).cast("binary"))
    cut = [h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind, headers: dict[str, Column], block: Column) -> Column:
    """A record without its end; headers that are null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers.items()]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), *lines, length)
    return F.concat(head, F.lit(_END), block)


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Writes a capture for each row of (page_id, url, html) as gzipped archives.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, that with the largest page_id is the
    response (of repeated rows with that id, one), others are revisits of it. Null html is an empty
    payload, a null url has no WARC-Target-URI, a null page_id an empty page-id, which counts as the smallest.
    Line ends in urls are escaped. Small, medium and large payloads go to archives of their own
    (``ARCHIVES``), each in a folder below ``path``; an archive is read by one task. Other columns are not read.
    """
    rows = with_row_keys(
        pages.select("page_id", "url", "html"),
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).select("page_id", "url", "html", "row_file", "row_at").withColumns({"__bytes": F.octet_length("html").cast("long"), "__sha1": F.sha1(F.col("html").cast("binary"))})
    large = F.col("__bytes") >= min_revisit_bytes
    stored = (
        rows.where(large)
        .groupBy("__sha1")
        .agg(F.max(F.struct("page_id", "row_file", "row_at", "url")).alias("first"), F.count("*").alias("__copies"))
        .where("__copies > 1")
        .select(F.col("__sha1").alias("__key"), "first.*")
        .select(
            "__key",
            F.struct("row_file", "row_at").alias("__first"),
            _record_id("response").alias("__refers"),
            F.col("url").alias("__to"),
        )
    )
    # rows that cannot be revisits get a key of their own instead of meeting under a null
    alone = F.concat_ws(" ", F.lit("row"), "row_file", "row_at")
    keyed = rows.withColumn("__key", F.when(large, F.col("__sha1")).otherwise(alone))
    known = keyed.join(stored, "__key", "left")
    again = F.col("__first").isNotNull() & (F.col("__first") != F.struct("row_file", "row_at"))
    main = F.when(again, _record_id("revisit")).otherwise(_record_id("response"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("__bytes").cast("string"),
        F.lit(_END),
    )
    common = {"WARC-Date": F.lit(date), "WARC-Target-URI": F.col("url")}
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    response = _record(
        kind,
        {
            "WARC-Record-ID": main,
            **common,
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "__sha1"),
            "WARC-Profile": F.when(
                again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
            ),
            "WARC-Refers-To": F.when(again, F.col("__refers")),
            "WARC-Refers-To-Target-URI": F.when(again, F.col("__to")),
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        F.when(again, http).otherwise(F.concat(http, "html")),
    )
    request = _record(
        F.lit("request"),
        {
            "WARC-Record-ID": _record_id("request"),
            **common,
            "WARC-Concurrent-To": main,
            "Content-Type": F.lit("application/http; msgtype=request"),
        },
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + _END)),
    )
    metadata = _record(
        F.lit("metadata"),
        {
            "WARC-Record-ID": _record_id("metadata"),
            **common,
            "WARC-Concurrent-To": main,
            "Content-Type": F.lit("application/warc-fields"),
        },
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")),
    )
    largest = rows.agg(F.max("__bytes")).first()[0] or 0
    least = 0
    for below, captures in ARCHIVES:
        if least <= largest:
            size = F.col("__bytes") >= least if below is None else F.col("__bytes").between(least, below - 1)
            (
                known.where(size)
                .select(F.concat_ws(_END, request, response, metadata).alias("value"))
                .write.option("lineSep", _END)
                .option("compression", "gzip")
                .option("maxRecordsPerFile", captures)
                .text(f"{path}/payloads-from-{least}")
            )
        least = below or least


class _Stream:
    """Bytes of an archive, unpacked as they are read; gzip members may follow each other."""

    def __init__(self, data: bytes):
        self.data, self.at, self.ready = memoryview(data), 0, bytearray()
        self.zip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _fill(self) -> bool:
        if self.at >= len(self.data):
            return False
        chunk = self.data[self.at : self.at + (1 << 20)]
        self.at += len(chunk)
        if self.zip is None:
            self.ready += chunk
            return True
        self.ready += self.zip.decompress(chunk)
        while self.zip.eof:
            rest = self.zip.unused_data
            self.zip = zlib.decompressobj(31)
            if not rest:
                break
            self.ready += self.zip.decompress(rest)
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (k := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark))
            if not self._fill():
                return None
        return self._take(k + len(mark))

    def exactly(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._fill():
                raise ValueError("archive ends within a record")
        return self._take(n)

    def _take(self, n: int) -> bytes:
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.lstrip(b"\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        yield headers, stream.exactly(int(headers["content-length"]))
        stream.until(b"\r\n\r\n")
    if stream.ready.strip():
        raise ValueError("archive ends within a record")


_RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("stored_digest", T.StringType()),
        T.StructField("http_headers", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _fields(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, http, payload, size, digest = headers.get("warc-type"), None, None, None, None
    stored = headers.get("warc-payload-digest")
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
        if kind == "response":
            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        else:  # headers are those of the stored response
            payload = None
            sizes = [x.partition(":")[2] for x in http.split("\r\n") if x.lower().startswith("content-length:")]
            size = int(sizes[0]) if sizes else None
            digest = stored.removeprefix("sha1:") if stored else None
    elif kind == "request":
        http = block.decode("utf-8", "replace")
    else:
        payload = block
    keep = with_payload or kind not in ("response", "revisit")
    return (
        headers.get("warc-record-id"),
        kind,
        headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"),
        headers.get("warc-target-uri"),
        headers.get("warc-date"),
        stored,
        http,
        size,
        digest,
        payload if keep else None,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives below ``path``, gzipped or plain. A folder without
    archives gives an empty table; a broken archive is an error."""

    types = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        arrays = [pa.array(c, types[f.dataType]) for c, f in zip(columns, _RECORDS)]
        return pa.RecordBatch.from_arrays(arrays, _RECORDS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            content = files.column("content")
            for k in range(files.num_rows):
                rows, size = [], 0
                for headers, block in parse(content[k].as_py()):
                    rows.append(_fields(headers, block, with_payload))
                    size += len(block) if with_payload else 100
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where("length > 0").select("content").mapInArrow(run, _RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """A row (record_id, record_type, target_uri, date, payload_digest, payload_bytes, payload, refers_to,
    request struct, response struct, metadata struct) for each response or revisit.

    request and metadata are the records that name the capture in WARC-Concurrent-To, of several that
    with the smallest id; null if there is none. Records that belong to no capture are left out, as is a
    main record without an id. Repeated main records come out as often as they are there.
    """

    def named(kind: str, *fields: str) -> DataFrame:
        some = records.where((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
        return some.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min(F.struct(F.col("record_id").alias("id"), *fields)).alias(kind)
        )

    main = records.where("kind in ('response', 'revisit') and record_id is not null").select(
        "record_id",
        F.col("kind").alias("record_type"),
        "target_uri",
        "date",
        "payload_digest",
        "payload_bytes",
        "payload",
        "refers_to",
        F.struct(F.col("record_id").alias("id"), "http_headers", "stored_digest").alias("response"),
    )
    requests, metadata = named("request", "http_headers"), named("metadata", "payload")
    return main.join(requests, "record_id", "left").join(metadata, "record_id", "left")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    captures = assemble(materialise(read_records(spark, path, with_payload=False), "records"))
    page_id = F.regexp_extract(F.col("metadata.payload").cast("string"), r"page-id: (-?[0-9]+)", 1)
    light = captures.select(
        "record_id",
        F.when(page_id != "", page_id).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.coalesce("refers_to", F.concat(F.lit("none of "), "record_id")).alias("__to"),
    )
    light = materialise(light, "captures")
    stored = light.where("record_type = 'response'").select(
        F.col("record_id").alias("__to"), F.col("page_id").alias("refers_to")
    )
    return light.join(stored, "__to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP7_SQL = """
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, first_value(r) OVER w AS first_r, first_value(page_id) OVER w AS first_id FROM p
  WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, r))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND r <> first_r THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND r <> first_r THEN first_id END AS refers_to
FROM f
"""
