"""Near duplicates by MinHash with tensored banding.

A document is the set of its WORDS-word shingles. Two small collections of minhash bands,
U and V with n bands of ROWS minhashes each, are combined into n * n tables: the key of table
(i, j) is band i of U together with band j of V. That takes 2 * n * ROWS minhashes where
independent tables would take n * n * 2 * ROWS.

Steps, all on tables in the shared folder:

1. Documents with equal sets become one class, so copies cost one row whatever their number.
2. Classes that share no U band with any other drop out; the rest get their table keys.
3. In each table's buckets every class is compared with one leader of the bucket: first with
   the smallest, then with others drawn by a hash. Links are confirmed on full sets.
   Components are found, and buckets that lie inside one component are done.
4. What remains is compared completely: members of a bucket in different components, block
   against block. An upper bound from small sketches (exact, never too low) rules out most
   pairs inside the task; pairs that pass are confirmed on full sets.

So no pair that meets in any bucket is lost, and pairs are never listed for a whole group: a
large group of near copies is linked through leaders. Two sets with similarity s meet nowhere
with probability below 2 * (1 - s ** ROWS) ** n. n is LEAST_BANDS at least and such that this
is at most MISS at the similarity asked for: 9 for 0.85, 12 for 0.8.

Defined results: null or empty text, or text without words: no shingles, linked with nothing,
its own component. Fewer words than WORDS: the whole sequence is the one shingle. A null
doc_id has a null component_id and is kept; it links others all the same. Rows that repeat
are one class; all rows with the component's smallest doc_id are kept (the stage of the
pipeline keeps one of them). An empty table gives an empty result. Columns besides doc_id
and text are not looked at.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import rows, tokens
from toolgauge.llm.components import components
from toolgauge.session import settle

WORDS = 3
PERCENT = 85
ROWS = 3
LEAST_BANDS = 9
# How likely a link at the threshold may meet in no table.
MISS = 4e-4
# Rounds of leaders before the complete comparison.
LEADER_ROUNDS = 3
SKETCH = 128
BLOCK = 1024

_MIX = np.uint64(0x9E3779B97F4A7C15)


def band_count(percent: int) -> int:
    """Bands of U, and of V, that keep the bound on lost links at MISS."""
    count = LEAST_BANDS
    while 2 * (1 - (percent / 100) ** ROWS) ** count > MISS:
        count += 1
    return count


@functools.cache
def _salts(count: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, 2 * count * ROWS).astype(np.uint64) | np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The set of a text as sorted different 64-bit hashes of its lower-cased shingles."""
    parts = text.lower().split()  # bytes: A-Z and the six ASCII white-space characters only
    if not parts:
        return np.zeros(0, np.uint64)
    n = min(words, len(parts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    mixed = np.zeros(len(parts) - n + 1, np.uint64)
    for k in range(n):
        mixed = _mix(mixed + hashes[k : k + len(mixed)])
    mixed.sort()
    keep = np.ones(len(mixed), bool)
    keep[1:] = mixed[1:] != mixed[:-1]
    return mixed[keep]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def bands(found: np.ndarray, count: int) -> np.ndarray:
    """2 * count hashes: each of ROWS minhashes."""
    salts = _salts(count)
    least = np.empty(len(salts), np.uint64)
    for k, salt in enumerate(salts):
        least[k] = (_odd(found ^ salt) * salt).min()
    joined = np.zeros(2 * count, np.uint64)
    for k in range(ROWS):
        joined = _mix(joined + least.reshape(2 * count, ROWS)[:, k])
    return joined.view(np.int64)


def _odd(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(33))


def sketch(found: np.ndarray) -> bytes:
    """How many shingles fall into each of SKETCH classes, at most 255."""
    counts = np.bincount((found >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def classes(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """place, doc_id, text -> place, doc_id, n_shingles, same (digest of the set), bands, sketch."""
    count = band_count(percent)

    def run(batches):
        tokens.worker_cache("none")
        for batch in rows.parts(batches, "text", 16 << 20):
            seen: dict[bytes, tuple] = {}
            out = []
            for text in batch.column("text").to_pylist():
                if text not in seen:
                    found = shingles(text, words)
                    seen[text] = (
                        (len(found), hashlib.sha256(found.tobytes()).digest(), bands(found, count).tolist(), sketch(found))
                        if len(found) else (0, None, None, None)
                    )
                out.append(seen[text])
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["place", "doc_id", "n_shingles", "same", "bands", "sketch"],
            )

    return docs.select("place", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "place long, doc_id long, n_shingles long, same binary, bands array<long>, sketch binary"
    )


def sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """place, text; wanted: place -> node (place), found (the set's hashes)."""

    def run(batches):
        for batch in rows.parts(batches, "text"):
            found = [shingles(text, words).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(found, pa.binary())], names=["node", "found"])

    some = docs.select("place", F.col("text").cast("binary").alias("text")).join(wanted, "place", "left_semi")
    return some.mapInArrow(run, "node long, found binary")


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """a, b -> the pairs whose sets are similar enough."""

    def run(batches):
        for batch in rows.parts(batches, "one"):
            ok = []
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                ok.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda node, name: full.select(F.col("node").alias(node), F.col("found").alias(name))
    return pairs.join(side("a", "one"), "a").join(side("b", "two"), "b").mapInArrow(run, "a long, b long")


def _possible(a: dict, b: dict, percent: int) -> np.ndarray:
    """Matrix of pairs that sketches cannot rule out.

    Sets of sizes x and y need 100 * i >= percent * (x + y - i), so at most
    x + y - 2 * i = x + y - 2 * percent * (x + y) / (100 + percent) elements in one of them
    only. The counts of the two sketches differ by no more than that number.
    """
    total = a["size"][:, None] + b["size"][None, :]
    allowed = total - 2 * np.ceil(percent * total / (100 + percent) - 1e-9)
    differ = np.zeros(total.shape, np.int64)
    one, two = a["sketch"].astype(np.int16), b["sketch"].astype(np.int16)
    for k in range(0, SKETCH, 8):
        differ += np.abs(one[:, None, k : k + 8] - two[None, :, k : k + 8]).sum(axis=2, dtype=np.int64)
    return differ <= allowed


def _crossing(percent: int):
    """Groups (key, first block, second block) of members -> pairs to confirm."""
    count = band_count(percent)

    def run(table):
        size = table.column("n_shingles").to_numpy()
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        found = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, 2 * count)
        i, j = table.column("i").to_numpy()[0], table.column("j").to_numpy()[0]
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        block = table.column("block").to_numpy()
        first, second = table.column("first").to_numpy()[0], table.column("second").to_numpy()[0]
        pick = lambda at: {"size": size[at], "sketch": sketches[at], "node": node[at], "component": component[at], "bands": found[at]}
        a, b = pick(block == first), pick(block == second)
        # A pair belongs to the first table in which it meets and is left out in all others.
        equal = a["bands"][:, None, :] == b["bands"][None, :, :]
        own = (equal[:, :, :count].argmax(axis=2) == i) & (equal[:, :, count:].argmax(axis=2) == j)
        own &= a["component"][:, None] != b["component"][None, :]
        maybe = own & _possible(a, b, percent) if own.any() else own
        left, right = np.nonzero(maybe)
        one, two = a["node"][left], b["node"][right]
        return pa.table({"a": np.minimum(one, two), "b": np.maximum(one, two)})

    return run


def connected(docs: DataFrame, found: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """place, text; settled classes, one row each -> node, component from confirmed links."""
    count = band_count(percent)
    sized = found.select(F.col("place").alias("node"), "n_shingles", "sketch", "bands")
    split = found.select(
        F.col("place").alias("node"), "n_shingles",
        F.slice("bands", 1, count).alias("u"), F.slice("bands", count + 1, count).alias("v"),
    )
    # Alone in all its U bands, a class is alone in all tables.
    banded = split.select("node", F.posexplode("u").alias("i", "band"))
    shared = banded.groupBy("i", "band").agg(F.count("*").alias("n")).filter("n > 1").select("i", "band")
    company = settle(banded.join(shared, ["i", "band"]).select("node").distinct())
    keys = (
        split.join(company, "node")
        .select("node", F.posexplode("u").alias("i", "x"), "v")
        .select("node", "i", "x", F.posexplode("v").alias("j", "y"))
        .select("node", "i", "j", F.xxhash64("i", "x", "j", "y").alias("key"))
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    tables = settle(keys.join(shared, "key").select("key", "i", "j", "node"))
    full = settle(sets(docs, tables.select(F.col("node").alias("place")).distinct(), words))
    sized = settle(sized.join(full.select("node"), "node"))

    def apart(members: DataFrame) -> DataFrame:
        """Members of buckets that hold several components."""
        open_keys = (
            members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low != high").select("key")
        )
        return members.join(open_keys, "key")

    def labelled(known: DataFrame | None) -> DataFrame:
        if known is None:
            return tables.withColumn("component", F.col("node"))
        return tables.join(known, "node", "left").select(
            "key", "i", "j", "node", F.coalesce("component", "node").alias("component")
        )

    known: DataFrame | None = None
    for turn in range(LEADER_ROUNDS + 1):
        members = settle(apart(labelled(known)))
        if members.isEmpty():
            # Every bucket lies inside one component.
            break
        if turn < LEADER_ROUNDS:
            draw = F.struct((F.xxhash64("node", F.lit(turn)) if turn else F.lit(0).cast("long")).alias("draw"), "node", "component")
            leaders = members.groupBy("key").agg(F.min(draw).alias("lead"))
            pairs = (
                members.join(leaders, "key").filter("component != lead.component")
                .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
                .distinct()
            )
        else:
            pairs = _remaining(members, sized, percent)
        new = settle(confirmed(pairs, full, percent))
        if not new.isEmpty():
            known = settle(_joined(known, new))
    return sized.select("node", F.col("node").alias("component")).limit(0) if known is None else known


def _joined(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, component, after more links: only what they join is looked at again."""
    if known is None:
        return components(links)
    of = lambda name: known.toDF(name, f"of_{name}")
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("of_a", "a").alias("x"), F.coalesce("of_b", "b").alias("y")
    )
    ends = settle(ends)
    grown = settle(components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))).toDF("component", "lower")
    fresh = ends.select("a").union(ends.select("b")).distinct().toDF("node").join(known, "node", "left_anti")
    return known.union(fresh.withColumn("component", F.col("node"))).join(grown, "component", "left").select(
        "node", F.coalesce("lower", "component").alias("component")
    )


def _remaining(members: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that sketches cannot rule out, from blocks of each bucket."""
    # In buckets of two the leaders' round has compared all there is.
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 2")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (
        members.join(sizes, "key").join(sized, "node")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    # A member goes to the pairs of its block with every block of the bucket.
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "i", "j", "node", "component", "n_shingles", "sketch", "bands", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
    )
    # Work follows pairs, not bytes: as many partitions as the session shuffles to.
    count = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartition(count, "key", "first", "second")
    return dealt.groupBy("key", "first", "second").applyInArrow(_crossing(percent), "a long, b long").distinct()


def near_groups(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """place, doc_id, text -> doc_id, n_shingles, component_id, place, first (one row per component)."""
    every = settle(classes(docs, percent, words))
    placed = F.struct("place", "n_shingles", "bands", "sketch")
    found = settle(
        every.filter("n_shingles > 0").groupBy("same").agg(F.min(placed).alias("one"))
        .select("same", "one.*")
    )
    known = connected(docs, found, percent, words)
    labels = found.join(known.withColumnRenamed("node", "place"), "place", "left").select(
        "same", F.coalesce("component", "place").alias("component")
    )
    # A document without shingles is a group of its own; places are not negative.
    grouped = settle(
        every.drop("bands", "sketch").join(labels, "same", "left")
        .withColumn("component", F.coalesce("component", -1 - F.col("place")))
        .drop("same")
    )
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    least = grouped.groupBy("component").agg(F.min(first).alias("stays"))
    return grouped.join(least, "component").select(
        "doc_id", "n_shingles", F.col("stays.doc_id").alias("component_id"), "place",
        (F.col("place") == F.col("stays.place")).alias("first"),
    )


def _input(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    placed, place = rows.numbered(docs)
    seen = placed.select(
        F.col(place).alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return placed, seen, place


def find_near(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept."""
    found = near_groups(_input(docs.select("doc_id", "text"))[1], percent, words)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The rows of `docs`, all columns: one of each group of near duplicates."""
    placed, seen, place = _input(docs)
    return rows.only(placed, place, near_groups(seen, percent, words).filter("first").select(F.col("place").alias(place)))
