"""WARC archives with a Zstandard dictionary per archive.

An archive is one file: a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then one Zstandard frame per record, so that every record can be
read alone. The dictionary is trained on the records of the archive itself, as
many as fit ``DICT_TRAIN_BYTES``; archives too small to train on use their first
records as raw-content dictionary.

Writing: a task packs the rows of its partition into archives of about
``ARCHIVE_BYTES`` of payload, and Spark's own writer stores each archive as one
file. So files appear only when the job commits, a lost executor costs a retry,
and any file system that Spark writes to will do. Spark's text writer ends each
file with its line separator; that is set to the eight bytes of an empty
skippable frame, which a Zstandard reader passes over. (The writer names the
files ``part-*.txt``; the content is a ``.warc.zst``.)

Equal payloads of at least ``MIN_REVISIT_BYTES`` are stored once: the record with
the smallest page_id is the response, the others are revisits that name it. Only
digests shuffle; the digests that occur more than once are written as a table of
their own, so that the planner knows its size before it joins the payloads.

Defined results: a null html is an empty payload. Rows that repeat the smallest
page_id of a payload are all responses. A null page_id sorts after all others and
its record has no page_id; if all are null, all are responses. A null url gives a
record without target URI; control characters in a url are percent-encoded.
An empty table gives no archive and reads back as an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import scratch

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 32 << 10
DICT_TRAIN_BYTES = 2 << 20
LEVEL = 3
#: Fixed values of the WARC/1.1 and Zstandard formats.
DICT_MAGIC = bytes([0x5D, 0x2A, 0x4D, 0x18])
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "record_type string, page_id bigint, refers_to bigint, url string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)


def plan_records(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Per page what its record is: payload, digest, type and the page referred to."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256)})
    repeated = scratch.materialise(
        rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1 AND _first IS NOT NULL")
        .drop("_n"),
        "warc-repeated",
    )
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(repeated, F.col("payload_digest") == F.col("_digest"), "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "page_id",
        F.when(revisit, F.col("_first")).alias("refers_to"),
        "url",
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_bytes(kind, page_id, refers_to, url, digest, size, payload) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url is not None:
        clean = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> bytes:
    """A dictionary for these records, trained on an even spread of them."""
    total = sum(map(len, records))
    step = max(1, -(-total // DICT_TRAIN_BYTES))
    sample = records[::step]
    try:
        size = min(DICT_BYTES, max(1024, total // 16))
        return zstandard.train_dictionary(size, sample, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICT_BYTES]


def archive_bytes(records: list[bytes]) -> bytes:
    """The leading dictionary frame and a frame per record."""
    words = _dictionary(records)
    squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words))
    return b"".join([DICT_MAGIC, len(words).to_bytes(4, "little"), words, *map(squeeze.compress, records)])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([("archive", pa.binary())])
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in batch.schema.names)):
            held.append(record_bytes(*row))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([archive_bytes(held)], pa.binary())], schema=out)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([archive_bytes(held)], pa.binary())], schema=out)


def write_archives(records: DataFrame, path: str) -> None:
    """Store the records of ``plan_records`` as archives in the folder ``path``."""
    (
        records.mapInArrow(_pack, "archive binary")
        .select(F.col("archive").cast("string"))
        .write.option("lineSep", EMPTY_FRAME)
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def frame_size(data: memoryview, at: int) -> int:
    """Bytes of the Zstandard frame that begins at ``at``."""
    head = zstandard.frame_header_size(data[at : at + 18])
    end = at + head
    while True:
        block = int.from_bytes(data[end : end + 3], "little")
        kind, size = (block >> 1) & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)
        if block & 1:
            break
    return end + 4 * bool(data[at + 4] & 4) - at


def records_of(archive: bytes) -> Iterator[bytes]:
    """The decompressed records of an archive."""
    data, at, expand = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if data[at + 1 : at + 4] == DICT_MAGIC[1:]:
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            if data[at : at + 4] == DICT_MAGIC:
                words = zstandard.ZstdCompressionDict(bytes(data[at + 8 : at + 8 + size]))
                expand = zstandard.ZstdDecompressor(dict_data=words)
            at += 8 + size
        else:
            size = frame_size(data, at)
            yield expand.decompress(data[at : at + size])
            at += size


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse_record(record: bytes) -> tuple:
    """The fields of ``RECORD_SCHEMA``; a response whose payload or length is damaged raises."""
    head, _, rest = record.partition(b"\r\n\r\n")
    field = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = field["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = field["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {field['WARC-Record-ID']}")
    return (
        kind,
        _number(field["WARC-Record-ID"]),
        _number(field.get("WARC-Refers-To")),
        field.get("WARC-Target-URI"),
        digest,
        size,
        payload if kind == "response" else None,
    )


def _unpack(keep_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        last = len(names) if keep_payload else -1
        for batch in batches:
            for archive in batch.column(0):
                rows = [parse_record(r)[:last] for r in records_of(archive.as_py())]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names[:last])

    return read


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``, checked against their digests."""
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.rpartition(",")[0]
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(_unpack(payloads), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, read the archives back, and list their records."""
    path = scratch.new_folder(spark, "warc")
    write_archives(plan_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
