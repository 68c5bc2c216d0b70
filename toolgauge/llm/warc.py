"""WARC archives of pages, compressed record by record with a shared dictionary.

An archive starts with a skippable frame that holds its dictionary; every record is one
Zstandard frame, so a reader can start at any of them. Pages whose payloads are equal and
of some size are stored once: the one with the largest page_id as a response, the others
as revisit records that refer to it.

Which page refers to which is settled by payload digests alone; payloads are shuffled once,
to the tasks that write. A digest that a third of the pages share is pre-aggregated, and
only rows of numbers and digests are joined on it.

Defined results: null html is an empty payload; a null url is written as about:blank, and
white space and control characters in a url are percent-encoded. A null page_id stays null
and sorts before all others. Of rows that repeat, the last in scan order is the response.
An empty table gives no archive and an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from toolgauge.llm import files, rows

MIN_SHARED_BYTES = 1000
# Bytes of records, before compression, after which a writer starts a new archive.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
# Bytes of records that an archive's dictionary is made from, spread over the archive.
SAMPLE_BYTES = 4 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def record_id(page_id, place: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{place}>"


def page_of(record: str):
    number = record.split(":")[2]
    return int(number) if number else None


def record(page_id, place, url, payload: bytes, refers_to: str | None) -> bytes:
    """One record, uncompressed; with `refers_to` a revisit, which leaves the payload out."""
    block = HTTP_HEAD if refers_to else HTTP_HEAD + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", record_id(page_id, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if refers_to:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", refers_to)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """A dictionary in a skippable frame, then a frame per record."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records[::step], k=256, d=8)
    except zstandard.ZstdError:  # too few or too uniform records to learn from
        trained = None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    out = []
    if trained is not None:
        content = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        out.append(struct.pack("<II", SKIPPABLE, len(content)) + content)
    return b"".join([*out, *map(compressor.compress, records)])


def frames(data: bytes):
    """(offset, content) of each frame, using the dictionary that leads the archive."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        (size,) = struct.unpack_from("<I", data, 4)
        content, at = data[8 : 8 + size], 8 + size
        if len(content) != size:
            raise ValueError("the dictionary frame is cut off")
        if content[:4] == ZSTD_MAGIC:
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor, view = zstandard.ZstdDecompressor(dict_data=dictionary), memoryview(data)
    while at < len(data):
        frame, parts, begin = decompressor.decompressobj(), [], at
        while not frame.eof:
            some = view[at : at + 16384]
            if not len(some):
                raise ValueError(f"the frame at {begin} is cut off")
            parts.append(frame.decompress(some))
            at += len(some) - len(frame.unused_data)
        yield begin, b"".join(parts)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of one record, with every length and digest checked."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header field: {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    block = rest[:length]
    if (said := fields.get("warc-block-digest")) and said != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError("block digest differs")
    return fields, block


def plan(pages: DataFrame) -> DataFrame:
    """place, page_id, payload -> place, refers_to (record id; null for responses)."""
    facts = pages.select(
        "place", "page_id", F.length("payload").alias("size"), F.sha2("payload", 256).alias("same")
    )
    # Nulls are the smallest in a struct's order.
    last = F.max(F.struct("page_id", "place")).alias("last")
    groups = (
        facts.filter(F.col("size") >= MIN_SHARED_BYTES).groupBy("same").agg(last, F.count("*").alias("n"))
        .filter("n > 1")
    )
    named = F.concat(
        F.lit("<urn:x-page:"), F.coalesce(F.col("last.page_id").cast("string"), F.lit("")),
        F.lit(":"), F.col("last.place").cast("string"), F.lit(">"),
    )
    return (
        facts.join(groups, "same")
        .filter("place != last.place")
        .select("place", named.alias("refers_to"))
    )


def write_archives(pages: DataFrame, folder: str) -> None:
    """page_id, url, html -> *.warc.zst files in `folder`."""
    placed, place = rows.numbered(pages.select("page_id", "url", "html"))
    placed = placed.select(
        F.col(place).alias("place"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    planned = placed.join(plan(placed), "place", "left").select("page_id", "place", "url", "payload", "refers_to")

    def write(batches):
        part, written, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            files.write(folder, f"part-{part:06d}-{written:06d}.warc.zst", archive(held))

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(record(*row))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    close()
                    held, size, written = [], 0, written + 1
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([written + bool(held)], pa.int64())], names=["n"])

    # In scan order within a task, so that a repeated attempt writes the same files.
    planned.sortWithinPartitions("place").mapInArrow(write, "n long").agg(F.sum("n")).first()


READ = (
    "record_id string, record_type string, page_id long, target_uri string, refers_to_id string,"
    " refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives. Damage of any kind ends the job with its place.

    Length and digest are of the full payload, for a revisit as its header gives them;
    `payload` is null for revisits, and for all when `payloads` is false.
    """
    names = [part.split()[0] for part in READ.split(", ")]

    def row(path: str, offset: int, content: bytes) -> tuple:
        try:
            fields, block = parse(content)
            kind, payload = fields["warc-type"], None
            digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
            if kind == "response":
                _, found, payload = block.partition(b"\r\n\r\n")
                if not found or len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError("the payload is not as its header says")
        except (ValueError, KeyError) as problem:
            raise ValueError(f"{path}, record at byte {offset}: {problem}") from problem
        refers = fields.get("warc-refers-to")
        return (
            fields["warc-record-id"], kind, page_of(fields["warc-record-id"]), fields.get("warc-target-uri"),
            refers, page_of(refers) if refers else None, size, digest, payload if payloads else None,
        )

    schema = pa.schema(
        [(n, pa.int64() if n in ("page_id", "refers_to", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in names]
    )

    def table(found):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def read(batches):
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content")):
                found, size = [], 0
                for offset, content in frames(data.as_py()):
                    found.append(row(path.as_py(), offset, content))
                    size += len(found[-1][-1] or b"") + 500
                    if size > 4 << 20:
                        yield table(found)
                        found, size = [], 0
                if found:
                    yield table(found)

    return files.contents(spark, folder, "*.warc.zst").mapInArrow(read, READ)
