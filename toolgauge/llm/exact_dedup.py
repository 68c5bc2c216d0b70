"""Exact duplicates by block naming: no hash decides whether two texts are equal.

A text (runs of white space made one space) is cut into blocks of BLOCK_BYTES. Equal
blocks meet in one partition, are sorted there, and get the partition number and their
rank as an integer name. Then adjacent names are paired and the pairs named in the same
way, round after round, until every text has one name. Two texts are equal exactly when
they have equally many blocks and the same name.

Scale: the text is shuffled once. Each batch of rows in a task first folds its own
copies, so a text or a block that fills a third of the table reaches the shuffle once per
batch. The rounds (a logarithm of the longest text's blocks) move pairs of numbers only,
and the shared folder holds each round's table, so lost executors repeat one round.

Defined results: null text equals empty text. A null doc_id sorts after all others; a
group that has nothing else has a null keep_id. Of rows that share text and doc_id, one
is kept. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import rows, tokens
from toolgauge.session import settle

BLOCK_BYTES = 4096
# A task hands on its rows when they add up to this.
_OUT_BYTES = 8 << 20

_OCCURRENCE = (
    "text long, pos int, blocks int, sha256 binary,"
    " members array<struct<doc_id: long, place: long>>"
)


def squeezed(text: bytes) -> bytes:
    """Each run of the six ASCII white-space bytes as one space."""
    body = b" ".join(text.split())
    if not body:
        return b" " if text else b""
    return b" " * (text[:1].isspace()) + body + b" " * (text[-1:].isspace())


def _cut(block_bytes: int):
    """place, doc_id, text -> one row per different block of a batch, with where it stands."""
    occurrence = pa.struct(
        [
            ("text", pa.int64()), ("pos", pa.int32()), ("blocks", pa.int32()),
            ("sha256", pa.binary()),
            ("members", pa.list_(pa.struct([("doc_id", pa.int64()), ("place", pa.int64())]))),
        ]
    )
    schema = pa.schema([("content", pa.binary()), ("found", pa.list_(occurrence))])

    def table(part):
        return pa.RecordBatch.from_pydict(
            {"content": list(part), "found": list(part.values())}, schema=schema
        )

    def cut(batches):
        tokens.worker_cache("none")
        number = TaskContext.get().partitionId() << 40
        for batch in rows.parts(batches, "text", 32 << 20):
            copies: dict[bytes, list] = {}
            columns = (batch.column(c) for c in ("place", "doc_id", "text"))
            for place, doc_id, text in zip(*(c.to_pylist() for c in columns)):
                member = {"doc_id": doc_id, "place": place}
                copies.setdefault(squeezed(text), []).append(member)
            part: dict[bytes, list] = {}
            size = 0
            for text, members in copies.items():
                count = max(1, -(-len(text) // block_bytes))
                for pos in range(count):
                    first = pos == 0
                    block = text[pos * block_bytes : (pos + 1) * block_bytes]
                    size += 32 + (len(block) if block not in part else 0) + 16 * len(members) * first
                    part.setdefault(block, []).append(
                        {
                            "text": number, "pos": pos, "blocks": count,
                            "sha256": hashlib.sha256(text).digest() if first else None,
                            "members": members if first else None,
                        }
                    )
                    if size > _OUT_BYTES:
                        yield table(part)
                        part, size = {}, 0
                number += 1
            if part:
                yield table(part)

    return cut


def _name_blocks(batches):
    """Sorted by content -> each occurrence with the name of its block."""
    base = TaskContext.get().partitionId() << 40
    last, rank = None, -1
    for batch in batches:
        names = []
        for content in batch.column("content").to_pylist():
            if content != last:
                last, rank = content, rank + 1
            names.append(base + rank)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), batch.column("found")], names=["name", "found"]
        )


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """Different pairs (a, b), sorted within partitions of their own, as integers."""
    return (
        pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
        .withColumn("name", F.monotonically_increasing_id())
    )


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """place, doc_id, text -> one row per batch and different text: blocks, name, members.

    Rows with equal (blocks, name) have equal texts, and the other way round.
    """
    spark = docs.sparkSession
    cut = docs.select("place", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _cut(block_bytes), f"content binary, found array<struct<{_OCCURRENCE}>>"
    )
    named = (
        cut.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "content")
        .sortWithinPartitions("content")
        .mapInArrow(_name_blocks, f"name long, found array<struct<{_OCCURRENCE}>>")
        .select("name", F.inline("found"))
    )
    first = settle(named)
    texts = first.filter("pos = 0").select("text", "blocks", "sha256", "members")
    done = first.filter("blocks = 1").select("text", "name")
    alive = first.filter("blocks > 1").select("text", "pos", "name", F.col("blocks").alias("left"))
    longest = first.agg(F.max("blocks")).first()[0] or 1
    while longest > 1:
        place = F.col("pos") % 2
        pairs = settle(
            alive.groupBy("text", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(place == 0, F.col("name"))).alias("a"),
                # No block has the name -1: it stands for "no second half".
                F.coalesce(F.max(F.when(place == 1, F.col("name"))), F.lit(-1)).alias("b"),
                F.ceil(F.max("left") / 2).cast("int").alias("left"),
            )
        )
        names = settle(_name_pairs(pairs))
        alive = settle(pairs.join(names, ["a", "b"]).drop("a", "b"))
        done = done.union(alive.filter("left = 1").select("text", "name"))
        alive = alive.filter("left > 1")
        longest = -(-longest // 2)
    return texts.join(done, "text")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """place, doc_id, text -> doc_id, keep_id, group_size, kept, text_sha256, place."""
    texts = settle(identities(docs, block_bytes))
    best = F.array_min(
        F.transform(
            "members",
            lambda m: F.struct(m["doc_id"].isNull().alias("none"), m["doc_id"], m["place"]),
        )
    )
    groups = texts.groupBy("blocks", "name").agg(
        F.min(best).alias("stays"), F.sum(F.size("members")).alias("group_size")
    )
    return (
        texts.join(groups, ["blocks", "name"])
        .select("stays", "group_size", "sha256", F.inline("members"))
        .select(
            "doc_id",
            F.col("stays.doc_id").alias("keep_id"),
            F.col("group_size").cast("long").alias("group_size"),
            (F.col("place") == F.col("stays.place")).alias("kept"),
            F.lower(F.hex("sha256")).alias("text_sha256"),
            "place",
        )
    )


def _input(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    placed, place = rows.numbered(docs)
    seen = placed.select(
        F.col(place).alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return placed, seen, place


def find_exact(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_groups(_input(docs)[1], block_bytes).drop("place")


def keep_first(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs`, all columns, without exact copies."""
    placed, seen, place = _input(docs)
    kept = exact_groups(seen, block_bytes).filter("kept")
    return rows.only(placed, place, kept.select(F.col("place").alias(place)))
