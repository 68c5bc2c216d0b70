"""Documents drawn to look like a target corpus: importance weights over hashed word runs.

Features are runs of one to `runs` words, each in the bucket of its CRC-32. Words follow a steep
law: a head of frequent ones makes up most occurrences. The head, counted over all documents, is
sent to all tasks with the CRC state after each word, and frequent pairs of head words with their
buckets; a longer run goes on from the state of its first words. What is not in the head (the
tail) takes its CRC directly. Both are exact, so the head's size decides about time only. Bucket
totals are exact sums over all documents and all target texts; a draw is by Gumbel noise from
a hash of doc_id, so it is the same on every run and needs no random state.

Defined results: null text has no words. A null doc_id draws with the noise of the text
`2024:`; rows that repeat or share a doc_id are rows of their own, and ties in score go to the
smaller doc_id (null last), then to the larger number of features, then to either. Documents
with fewer than `least_words` words are weighed, but not drawn. Without any target text, or any document, the formula holds
with zero totals. Very long texts are one row of two bytes per feature. Empty tables give an
empty result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import rows
from toolgauge.operators.ranking import dense_positions
from toolgauge.session import settle

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Words, and pairs of them, whose states are sent to all tasks: at most so many, of at most so
# many bytes each (8 MB of words; longer ones are tail).
HEAD = 1 << 16
HEAD_BYTES = 128

# Bytes between words; what words consist of is all else, A-Z lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a column of texts one after the other, and how many each text has."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(pa.array(real)), np.diff(before[ends])


def count_words(texts: DataFrame) -> DataFrame:
    """word, n: of all words of at most HEAD_BYTES bytes."""

    def run(batches):
        for batch in rows.parts(batches, "text", 16 << 20):
            counted = pc.value_counts(words_of(batch.column("text"))[0])
            word, n = counted.field("values"), counted.field("counts")
            short = pc.less_equal(pc.binary_length(word), HEAD_BYTES)
            yield pa.RecordBatch.from_arrays([word.filter(short), n.filter(short)], names=["word", "n"])

    counted = texts.select("text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Head:
    """Frequent words with the CRC state after each, and buckets of frequent pairs of them."""

    def __init__(self, words: list[str], buckets: int):
        self.buckets = buckets
        self.states = {word: zlib.crc32(word.encode()) for word in words}
        self.pairs: dict[tuple[str, str], int] = {}

    def learn_pairs(self, pairs) -> None:
        for a, b in pairs:
            self.pairs[a, b] = zlib.crc32(b" " + b.encode(), self.states[a]) % self.buckets

    def state(self, word: str) -> int:
        found = self.states.get(word)
        return zlib.crc32(word.encode()) if found is None else found

    def features(self, texts: pa.Array, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all runs, text by text, how many each text has, and its words."""
        flat, sizes = words_of(texts)
        coded = flat.dictionary_encode()
        different = coded.dictionary.to_pylist()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        states = np.fromiter(map(self.state, different), np.uint32, len(different))
        # The state so far of the run that starts at each word; runs stay within a text.
        found, owners = [states[at] % self.buckets], [np.repeat(np.arange(len(sizes)), sizes)]
        owner, so_far = owners[0], states[at]
        for length in range(2, runs + 1):
            starts = np.flatnonzero(owner[: len(at) - length + 1] == owner[length - 1 :])
            last = at[starts + length - 1]
            keys = so_far[starts].astype(np.uint64) << np.uint64(32) | last.astype(np.uint64)
            different_keys, first, where = np.unique(keys, return_index=True, return_inverse=True)
            ends, begins = last[first].tolist(), at[starts[first]].tolist()
            made = np.zeros(len(different_keys), np.uint32)
            for i, (key, a, b) in enumerate(zip(different_keys.tolist(), begins, ends)):
                pair = self.pairs.get((different[a], different[b])) if length == runs == 2 else None
                # A known pair that ends its run needs no state, only its bucket.
                made[i] = zlib.crc32(b" " + different[b].encode(), key >> 32) if pair is None else pair
            so_far = np.zeros(len(at), np.uint32)
            so_far[starts] = made[where]
            found.append(made[where] % self.buckets)
            owners.append(owner[starts])
        order = np.argsort(np.concatenate(owners), kind="stable") if runs > 1 else slice(None)
        owners = np.concatenate(owners)
        return np.concatenate(found)[order], np.bincount(owners, minlength=len(sizes)), sizes


def most_frequent(counted: DataFrame, most: int) -> list:
    """Rows with the highest `n`: all from some count on, and at most `most`.

    The count is read off a histogram, so tasks send no more than these rows and a few bins
    to the driver. Each bin holds counts within a twentieth of each other.
    """
    counted = settle(counted)
    step = F.floor(F.log2("n") * 16)
    bins = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    total, lowest = 0, None
    for step_, n in sorted(((row["step"], row["rows"]) for row in bins), reverse=True):
        total += n
        if total > most:
            break
        lowest = step_
    return [] if lowest is None else counted.filter(step >= lowest).collect()


def head_of(texts: DataFrame, runs: int, buckets: int, most: int = HEAD) -> Head:
    """The head of a corpus, from counts over all of it."""
    head = Head([row["word"] for row in most_frequent(count_words(texts), most)], buckets)
    if runs == 2:
        sent = texts.sparkSession.sparkContext.broadcast(head)

        def run(batches):
            known = sent.value.states
            for batch in rows.parts(batches, "text", 16 << 20):
                flat, sizes = words_of(batch.column("text"))
                coded = flat.dictionary_encode()
                different = coded.dictionary.to_pylist()
                at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                frequent = np.fromiter((word in known for word in different), bool, len(different))[at]
                both = (owner[1:] == owner[:-1]) & frequent[1:] & frequent[:-1]
                keys, n = np.unique((at[:-1] * len(different) + at[1:])[both], return_counts=True)
                a, b = np.divmod(keys, max(1, len(different)))
                taken = [coded.dictionary.take(pa.array(x)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([*taken, pa.array(n, pa.int64())], names=["a", "b", "n"])

        pairs = texts.select("text").mapInArrow(run, "a string, b string, n long").groupBy("a", "b")
        chosen = most_frequent(pairs.agg(F.sum("n").alias("n")), most)
        head.learn_pairs((row["a"], row["b"]) for row in chosen)
    return head


def featured(texts: DataFrame, head: Broadcast, runs: int) -> DataFrame:
    """doc_id, text -> doc_id, n_words, n_features, buckets (unsigned 16-bit, little-endian)."""

    def run(batches):
        for batch in rows.parts(batches, "text"):
            found, sizes, words = head.value.features(batch.column("text"), runs)
            data = found.astype("<u2").tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)]) * 2
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary()),
                ],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, buckets binary")


def totals(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall into each bucket, over all rows: `buckets` numbers."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column("buckets").to_pylist():
                counts += np.bincount(np.frombuffer(data, "<u2"), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    summed = features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths."""
    all_corpus, all_target, n = float(corpus.sum()), float(target.sum()), len(corpus)
    ratios = (
        (float(t) + 1) * (all_corpus + n) / ((float(s) + 1) * (all_target + n))
        for s, t in zip(corpus.tolist(), target.tolist())
    )
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weigh(features: DataFrame, gained: np.ndarray) -> DataFrame:
    """The floored mean of the gains of a document's features, as `weight`."""
    sent = features.sparkSession.sparkContext.broadcast(gained)

    def run(batches):
        for batch in batches:
            sums = [int(sent.value[np.frombuffer(data, "<u2")].sum()) for data in batch.column("buckets").to_pylist()]
            sizes = batch.column("n_features").to_pylist()
            weights = pa.array([s // n if n else 0 for s, n in zip(sums, sizes)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "n_words", "n_features"]).columns, weights],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def draw(
    texts: DataFrame,
    target: DataFrame,
    runs: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, text and target texts -> doc_id, n_features, weight, score, rank (null: not drawn)."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are stored in 16 bits")
    head = texts.sparkSession.sparkContext.broadcast(head_of(texts, runs, buckets))
    features = settle(featured(texts, head, runs))
    wanted = featured(target, head, runs)
    weighed = weigh(features, gains(totals(features, buckets), totals(wanted, buckets)))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = settle(
        weighed.withColumn("score", F.col("weight") + noise)
        .withColumn("short", F.col("n_words") < least_words)
        .withColumn("last_first", -F.col("score"))
    )
    # Scores take tens of thousands of values at most; documents too short to be drawn come last.
    order = [F.col("doc_id").asc_nulls_last(), F.col("n_features").desc()]
    eligible = scored.filter(~F.col("short")).count()
    placed = dense_positions(scored, ["short", "last_first"], order, "place")
    drawn = ~F.col("short") & (F.col("place") < percent * eligible // 100)
    return placed.select(
        "doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place") + 1).alias("rank")
    )
