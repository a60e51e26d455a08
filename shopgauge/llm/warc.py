"""WARC archives whose records are compressed one by one with a shared dictionary.

An archive is one file: a leading skippable frame holds the Zstandard
dictionary, built from the archive's own records, and every record follows as a
frame of its own. Spark's text writer puts the frames into files, with an empty
skippable frame as the separator, so each file is a valid stream of frames and
is committed as a whole or not at all when a task is lost.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm.common import slices

#: Magic numbers of skippable frames: the dictionary's, and the separator's ("P*M" and 0x18).
DICTIONARY, SEPARATOR = 0x184D2A5D, 0x184D2A50
#: An empty skippable frame, written after every record.
BETWEEN = struct.pack("<II", SEPARATOR, 0)
#: Shorter payloads are always kept in full.
LEAST_SHARED = 1000
#: The dictionary is built from so many bytes of the first records of an archive, and has so many bytes itself.
SAMPLE, DICTIONARY_SIZE = 4_000_000, 65_536
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URLs


def decide(pages: DataFrame) -> DataFrame:
    """Rows ``page_id, url, payload, sha1, refers_to``: which record revisits which.

    Of equal payloads of at least ``LEAST_SHARED`` bytes the one with the
    largest page_id is kept and the others refer to it. Equality is that of
    length and SHA-256. Copies are counted before the shuffle, and only the
    narrow keys of revisits are joined back by page, so a payload that a third
    of the pages share fills no task.

    Null html is an empty payload. Rows that repeat a page_id with the same
    payload are all responses if that id is the largest. A null page_id is
    smaller than any other.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    keyed = rows.select("page_id", F.length("payload").alias("size"), F.sha2("payload", 256).alias("key")).where(
        F.col("size") >= LEAST_SHARED
    )
    kept = keyed.groupBy("key", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    revisits = (
        keyed.join(kept, ["key", "size"])
        .where(~F.col("page_id").eqNullSafe(F.col("kept")))
        .select(F.col("page_id").alias("of"), F.col("key").alias("of_key"), F.col("kept").alias("refers_to"))
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("of")) & (F.sha2("payload", 256) == F.col("of_key"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), "refers_to")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head with the full length, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_for(sample: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; the records' own bytes where they are too few to train on."""
    size = min(DICTIONARY_SIZE, max(256, sum(map(len, sample)) // 10))
    try:
        return zstandard.train_dictionary(size, sample, threads=0)
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(sample)[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def frames(records: Iterator[bytes], level: int) -> Iterator[bytes]:
    """The dictionary frame, then a frame for each record; nothing for no records."""
    first: list[bytes] = []
    held = 0
    for one in records:
        first.append(one)
        held += len(one)
        if held >= SAMPLE:
            break
    if not first:
        return
    trained = dictionary_for([x[:131_072] for x in first])
    raw = trained.as_bytes()
    yield struct.pack("<II", DICTIONARY, len(raw)) + raw
    squeeze = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    for one in first:
        yield squeeze.compress(one)
    first.clear()
    for one in records:
        yield squeeze.compress(one)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", level: int = 3) -> None:
    """Write all pages as archives below ``path``, one for each Spark task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for part in slices(batches, 1024, 8_000_000):
                for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha1", "refers_to")), strict=True):
                    yield record(*row, date)

        for frame in frames(records(), level):
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["frame"])

    made = decide(pages).mapInArrow(run, "frame binary")
    made.select(F.col("frame").cast("string")).write.option("lineSep", BETWEEN.decode("latin-1")).text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one archive."""
    if not archive:
        return
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    raw = archive[8 : 8 + size]
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    known = zstandard.ZstdCompressionDict(raw, dict_type=kind)
    # the reader passes over skippable frames, here the dictionary and the separators
    unpacked = zstandard.ZstdDecompressor(dict_data=known).stream_reader(io.BytesIO(archive), read_across_frames=True)
    stream = io.BufferedReader(unpacked, 1 << 20)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("a record doesn't begin with its version")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    Digests of responses are computed from the payload that was read, and must
    equal those in the header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for archive in batch.column(0):
                rows = []
                for headers, block in parse(archive.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if headers["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"record {headers['warc-record-id']} was damaged")
                    page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                    rows.append((page and int(page), headers["warc-target-uri"], size, digest, headers["warc-type"], refers and int(refers)))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)
