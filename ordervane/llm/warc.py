"""Dictionary-compressed web archives: writing, and reading them back.

Every page becomes one WARC/1.1 record, compressed as a Zstandard frame of its own
with a shared dictionary, which each archive carries in a leading skippable frame.
The dictionary is trained on records of a bounded sample. Of equal payloads of some
size only one is stored as response; the others are revisit records naming it.
Archives are written by Spark's text writer, so they may lie in any store that Spark
reaches and a lost executor's tasks are simply repeated; the writer's line end is an
empty skippable frame, which readers of Zstandard pass over.

Inputs and results, also for odd ones: a null payload is written as an empty one.
A page without key gets a record without a page's name and is never referred to.
Of repeated rows with the smallest key all are responses. Long pages are stored
whole. An empty table gives no archive, and reading none gives no rows. Only the
named columns are read, further ones are dropped. Line ends in addresses are
percent-encoded.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the Zstandard and WARC formats.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # a skippable frame without content
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bound of the sample that the dictionary is trained on, and the dictionary's size.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 300, 64 << 10, 64 << 10
#: An archive is closed once its compressed records reach this size.
ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 100
_ID = "urn:x-page:"
#: The records' date, where none is given.
DATE = "2024-01-01T00:00:00Z"


def _body(payload: str) -> Column:
    return F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b""))


def classify(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
             min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``key``, ``url``, ``payload``, ``digest`` and ``refers_to``, null for what is stored as response."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), _body(payload).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= min_bytes
    shared = (rows.filter(long).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    refers = F.when(long & (F.col("key").isNull() | (F.col("key") != F.col("first"))), F.col("first"))
    return rows.join(shared, "digest", "left").select("key", "url", "payload", "digest", refers.alias("refers_to"))


def record(key, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One uncompressed WARC record around an HTTP response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    head.append(f"WARC-Record-ID: <{_ID}{'' if key is None else key}>")
    head.append(f"WARC-Date: {date}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                     date: str = DATE, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the records of a bounded sample of pages; empty where there are too few.

    Pages are drawn by a hash of their content, at a share that gives about twice
    ``SAMPLE_PAGES`` of them, whatever the number of tasks.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), _body(payload).alias("payload"))
    share = min(1.0, 2 * SAMPLE_PAGES / max(1, rows.count()))
    drawn = F.pmod(F.xxhash64("payload"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = (rows.filter(drawn & (F.octet_length("payload") <= SAMPLE_BYTES)).limit(SAMPLE_PAGES)
              .withColumn("digest", F.sha2("payload", 256)).collect())
    records = [record(r["key"], r["url"], bytes(r["payload"]), r["digest"], None, date) for r in sample]
    if len(records) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, records)) // 4), records).as_bytes()
    except zstandard.ZstdError:  # too little content for a dictionary
        return b""


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, date: str = DATE, level: int = 3,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes classified pages as archives of bounded size below ``folder``."""

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)
        lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        frames, held = [lead], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                for row in batch.slice(begin, 256).to_pylist():
                    frame = packer.compress(record(**row, date=date))
                    frames.append(frame)
                    held += len(frame)
                    if held >= archive_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])
                        frames, held = [lead], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])

    archives = pages.select("key", "url", "payload", "digest", "refers_to").mapInArrow(archived, "archive binary")
    (archives.select(F.col("archive").cast("string").alias("value")).write.mode("overwrite")
     .option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", EMPTY_FRAME).text(folder))


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields and the block of every record of one archive."""
    magic, size = struct.unpack("<II", archive[:8])
    shared = zstandard.ZstdCompressionDict(archive[8:8 + size]) if magic == DICTIONARY_MAGIC else None
    unpacker = zstandard.ZstdDecompressor(dict_data=shared)
    lines = io.BufferedReader(unpacker.stream_reader(archive, read_across_frames=True), 1 << 20)
    while version := lines.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        fields = {}
        while line := lines.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block = lines.read(int(fields["Content-Length"]))
        lines.read(4)
        yield fields, block


def _row(fields: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    name, refers = (fields.get(f, "").strip("<>").removeprefix(_ID) or None for f in ("WARC-Record-ID", "WARC-Refers-To"))
    kind = fields["WARC-Type"]
    return (name, kind, fields.get("WARC-Target-URI"), refers, fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            length, payload if kind == "response" else None)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: ``name``, ``record_type``, ``url``, ``refers_to``, ``digest``, ``payload_bytes``, ``payload``."""
    columns = ["name", "record_type", "url", "refers_to", "digest", "payload_bytes", "payload"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*found, strict=True), kinds, strict=True)], columns)

        for batch in batches:
            for archive in batch.column("content"):
                found: list[tuple] = []
                for fields, block in read_records(archive.as_py()):
                    found.append(_row(fields, block))
                    if len(found) == 256:
                        yield packed(found)
                        found = []
                if found:
                    yield packed(found)

    schema = ", ".join(f"{c} {'bigint' if c == 'payload_bytes' else 'binary' if c == 'payload' else 'string'}" for c in columns)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.filter("length > 0").select("content").mapInArrow(rows, schema)
