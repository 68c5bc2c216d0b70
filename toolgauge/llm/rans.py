"""Token ids in files of blocks coded by asymmetric numeral systems (range variant).

One table of frequencies, counted over all ids, serves every file. A block codes up to
BLOCK_TOKENS ids on its own: ids are dealt to LANES states in turn, so a step codes one id
per lane with a handful of array operations. Blocks have checksums and the file's index
tells where each starts, in bytes and in ids, so blocks decode in parallel. Files cover
ranges of doc_id in ascending order; the order of names is the order of ids.

Layout of a file (little-endian): magic; header length u32; header (JSON: part, tokens
before the file in its part, blocks as [byte offset, bytes, first id, ids, lanes, crc32 of
the block's ids], crc32 of the table); docs as rows of (doc_id i64, null flag u8, ids u32);
then blocks. A block is its final states (u64 per lane) and the stream (u32 words).

Defined results: null text is empty text: the end id alone. A null doc_id comes first and
stays null. Rows that repeat are written as often as they come. An empty table gives an
empty result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from toolgauge.llm import files, rows, tokens
from toolgauge.session import shared_folder

MAGIC = b"TGRANS01"
END_ID = 1
BITS = 20
BLOCK_TOKENS = 1 << 20
LANES = 4096
FILE_TOKENS = 1 << 22
_LOW = np.uint64(1 << 31)
_DOC = np.dtype([("doc_id", "<i8"), ("none", "u1"), ("ids", "<u4")])


class Table:
    """Frequencies that add up to 2 ** BITS; every id that occurs has at least 1."""

    def __init__(self, counts: np.ndarray):
        total, size = int(counts.sum()), 1 << BITS
        frequency = np.where(counts > 0, np.maximum(1, counts * size // max(total, 1)), 0)
        # What rounding leaves goes to the most frequent id; an excess is taken in eighths.
        order = np.argsort(-frequency, kind="stable")
        left = size - int(frequency.sum())
        while left and total:
            for i in order:
                step = left if left > 0 else max(left, -(int(frequency[i]) // 8))
                frequency[i] += step
                left -= step
                if not left:
                    break
        self.frequency = frequency.astype(np.uint64)
        self.start = (np.cumsum(frequency) - frequency).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint16), frequency)
        self.crc = zlib.crc32(self.frequency.astype("<u4").tobytes())


def encode_block(ids: np.ndarray, table: Table, lanes: int) -> bytes:
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    words, bits = [], np.uint64(BITS)
    for t in range(steps - 1, -1, -1):
        part = ids[t * lanes : (t + 1) * lanes]
        x = state[: len(part)]
        f = table.frequency[part]
        full = x >= (f << np.uint64(63 - BITS))
        words.append(x[full].astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(part)] = (q << bits) + (x - q * f) + table.start[part]
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, count: int, lanes: int, table: Table) -> np.ndarray:
    state = np.frombuffer(data, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(data, "<u4", offset=8 * lanes)
    ids, used = np.empty(count, np.uint16), 0
    mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for begin in range(0, count, lanes):
        x = state[: min(lanes, count - begin)]
        slot = x & mask
        part = table.symbol[slot]
        ids[begin : begin + len(part)] = part
        x = table.frequency[part] * (x >> bits) + slot - table.start[part]
        need = np.flatnonzero(x < _LOW)
        x[need] = (x[need] << np.uint64(32)) | words[used : used + len(need)].astype(np.uint64)
        used += len(need)
        state[: len(x)] = x
    if used != len(words) or (state != _LOW).any():
        raise ValueError("damaged block: the stream does not end where it should")
    return ids


def encode_file(part: int, before: int, docs: list[tuple], ids: np.ndarray, table: Table) -> bytes:
    """docs: (doc_id or None, number of ids), in order; ids: all of theirs."""
    blocks, body, offset = [], [], 0
    for begin in range(0, len(ids), BLOCK_TOKENS):
        block = ids[begin : begin + BLOCK_TOKENS]
        lanes = 1
        while lanes < LANES and lanes * 256 <= len(block):
            lanes *= 2
        data = encode_block(block, table, lanes)
        crc = zlib.crc32(block.astype("<u2").tobytes())
        blocks.append([offset, len(data), begin, len(block), lanes, crc])
        body.append(data)
        offset += len(data)
    rows = np.array([(d or 0, d is None, n) for d, n in docs], _DOC).tobytes()
    header = {"part": part, "before": before, "docs": len(docs), "blocks": blocks, "table": table.crc}
    head = json.dumps(header, separators=(",", ":")).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, rows, *body])


def decode_file(data: bytes, table: Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """-> (header, rows of (doc_id, none, ids), ids of all documents)."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of token blocks")
    (length,) = struct.unpack_from("<I", data, 8)
    header = json.loads(data[12 : 12 + length])
    if header["table"] != table.crc:
        raise ValueError("the file was coded with another table")
    docs = np.frombuffer(data, _DOC, header["docs"], 12 + length)
    base = 12 + length + docs.nbytes
    parts = [np.zeros(0, np.uint16)]
    for offset, size, _, count, lanes, crc in header["blocks"]:
        ids = decode_block(data[base + offset : base + offset + size], count, lanes, table)
        if zlib.crc32(ids.astype("<u2").tobytes()) != crc:
            raise ValueError("damaged block: checksum differs")
        parts.append(ids)
    return header, docs, np.concatenate(parts)


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, text, in ranges of doc_id -> part, before, doc_id, low and high bytes of ids.

    The two bytes of an id go to columns of their own: the high ones repeat and shrink. A
    row without `low` ends each part; it has how often each id occurs in the part.
    """
    schema = pa.schema(
        [
            ("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()),
            ("low", pa.binary()), ("high", pa.binary()), ("counts", pa.binary()),
        ]
    )

    def encode_rows(batches):
        encode = tokens.library_encoder(path)
        part, before = TaskContext.get().partitionId(), 0
        counts = np.zeros(1 << 16, np.int64)
        for batch in rows.parts(batches, "text"):
            found = encode(batch.column("text").to_pylist())
            # All ids of the batch, each document's followed by the end id.
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
            flat = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint16)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = False
            flat[inside] = np.concatenate(found)
            counts += np.bincount(flat, minlength=1 << 16)
            n, places = len(found), np.concatenate([[0], ends])
            halves = [
                pa.Array.from_buffers(
                    pa.binary(), n, [None, pa.py_buffer(places.astype("<i4")), pa.py_buffer(half.astype(np.uint8))]
                )
                for half in (flat & 0xFF, flat >> 8)
            ]
            columns = ([part] * n, before + places[:-1], batch.column("doc_id"), *halves, [None] * n)
            before += len(flat)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        columns = ([part], [before], [None], [None], [None], [counts.astype("<i8").tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", "text").repartitionByRange(count, "doc_id")
    return ranged.sortWithinPartitions("doc_id", "text").mapInArrow(
        encode_rows, "part int, before long, doc_id long, low binary, high binary, counts binary"
    )


def _ids(low: bytes, high: bytes) -> np.ndarray:
    pair = np.empty((len(low), 2), np.uint8)
    pair[:, 0] = np.frombuffer(low, np.uint8)
    pair[:, 1] = np.frombuffer(high, np.uint8)
    return pair.view("<u2").ravel()


def count_ids(coded: DataFrame) -> np.ndarray:
    """How often each id occurs among all; ids have 16 bits, so the result is bounded."""

    def count(batches):
        totals = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                totals += np.frombuffer(counts, "<i8")
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at])], names=["id", "n"])

    parts = coded.filter("counts IS NOT NULL").select("counts")
    found = parts.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    totals = np.zeros(1 << 16, np.int64)
    for row in found.collect():
        totals[row.id] = row.n
    return totals


def write_files(coded: DataFrame, counts: np.ndarray, folder: str) -> None:
    """Write part files; the table lies beside them as `table.bin`."""
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast(counts)  # 2 ** 16 numbers

    def write(batches):
        table = Table(shared.value)
        part, before, docs, ids, size, n = None, 0, [], [], 0, 0

        def close():
            # The name says where the ids stand and how many they are, so that starts can be
            # summed up without opening a file.
            name = f"part-{part:06d}-{before:015d}-{size:010d}.rans"
            files.write(folder, name, encode_file(part, before, docs, np.concatenate(ids), table))

        for batch in batches:
            for at, start, doc_id, low, high in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if docs and (at != part or size >= FILE_TOKENS):
                    close()
                    docs, ids, size, n = [], [], 0, n + 1
                if not docs:
                    part, before = at, start
                docs.append((doc_id, len(low)))
                ids.append(_ids(low, high))
                size += len(low)
        if docs:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n + bool(docs)], pa.int64())], names=["files"])

    documents = coded.filter("low IS NOT NULL").select("part", "before", "doc_id", "low", "high")
    documents.mapInArrow(write, "files long").agg(
        F.sum("files")
    ).first()
    files.write(folder, "table.bin", counts.astype("<i8").tobytes())


def read_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32, ids.

    `ids` are the document's ids as unsigned 16-bit little-endian integers; null if not
    asked for.
    """
    saved = files.contents(spark, folder, "table.bin").first()
    shared = spark.sparkContext.broadcast(np.frombuffer(bytes(saved.content), "<i8"))

    def read(batches):
        table = Table(shared.value)
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), map(lambda one: one.as_py(), batch.column("content"))):
                header, docs, ids = decode_file(data, table)
                if not path.endswith(f"-{header['before']:015d}-{len(ids):010d}.rans"):
                    raise ValueError("the name of a file does not fit what is in it")
                ends = np.cumsum(docs["ids"].astype(np.int64))
                for k in range(0, len(docs), 2000):
                    some = slice(k, k + 2000)
                    spans = list(zip(ends[some] - docs["ids"][some], ends[some]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(spans), header["part"], np.int32)),
                            pa.array(docs["doc_id"][some].astype(np.int64), mask=docs["none"][some].astype(bool)),
                            pa.array([header["before"] + int(a) for a, _ in spans], pa.int64()),
                            pa.array([int(b - a) for a, b in spans], pa.int64()),
                            pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in spans], pa.int64()),
                            pa.array([ids[a:b].astype("<u2").tobytes() if with_ids else None for a, b in spans], pa.binary()),
                        ],
                        names=["part", "doc_id", "inside", "n_tokens", "ids_crc32", "ids"],
                    )

    found = files.contents(spark, folder, "part-*.rans").mapInArrow(
        read, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    return _starts(found, files.contents(spark, folder, "part-*.rans").select("path"))


def _starts(found: DataFrame, names: DataFrame) -> DataFrame:
    """Turn places inside a part into places among all ids: one sum per part runs along."""

    def number(group):
        return F.regexp_extract("path", r"part-(\d+)-\d+-(\d+)\.rans$", group)

    sizes = names.groupBy(number(1).cast("int").alias("part")).agg(F.sum(number(2).cast("long")).alias("_size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    # One row per part, at most as many as the writer's shuffle had partitions.
    return found.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("_base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def write_documents(docs: DataFrame, path: str, folder: str) -> None:
    """Encode doc_id, text with a tokenizer file and write part files to `folder`."""
    spark = docs.sparkSession
    kept = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    coded = tokenize(docs, path)
    coded.write.option("compression", "zstd").parquet(kept)
    coded = spark.read.schema(coded.schema).parquet(kept)
    write_files(coded, count_ids(coded), folder)
