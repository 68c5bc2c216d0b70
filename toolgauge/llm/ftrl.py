"""Logistic regression over hashed word n-grams, trained by follow the regularised leader.

Texts become sets of 20-bit feature numbers, many texts at a time: words are hashed once
per worker, n-grams are mixed from word hashes with array operations, and a text's score
is a sparse dot product. Training takes a sample of labelled rows that is bounded by
MAX_TRAIN, in one task: per-coordinate learning rates and an L1 penalty leave a few
thousand weights, which are sent to all tasks. Everything else covers all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.llm import rows, tokens

BITS = 20
# Labelled documents that training takes at most: those with the smallest hash of doc_id.
MAX_TRAIN = 16_000
# A clean row called toxic weighs this many toxic rows called clean.
FALSE_ALARM = 3
_HELD = 500_000
_GROUP = 1 << 21
_WORD = regex.compile(r"\w+|[^\w\s]+")
# The same on ASCII texts, in half the time.
_ASCII_WORD = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\x0b\x0c]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Grams:
    """Which n-grams count as features."""

    lower: bool = True
    # Distances between the words of a pair: 1 is a bigram, more is a skip-gram.
    pairs: tuple[int, ...] = (1,)
    # Also n-grams of word shapes, by how large a share of the text they make up.
    shapes: int = 0
    # Also the share of word bigrams that came before in the text.
    repeats: bool = False


@dataclass(frozen=True)
class Settings:
    grams: Grams
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    # Power of (other label's rows / own label's rows) by which a row of the rarer label
    # counts more; 0 leaves rows as they are.
    balance: float = 0.0
    # Rows per row that is kept back to place the constant; 0 leaves it as trained.
    calibrate: int = 0


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def _shape(word: str) -> int:
    if not (word[0].isalnum() or word[0] == "_"):
        return 1 + min(len(word), 3)
    if word.isdigit():
        return 5
    if word.isupper():
        return 6 if len(word) > 1 else 7
    return 8 if word[0].isupper() else 9


class _Known(dict):
    """Numbers for words, with each new word's hash and shape noted."""

    def __init__(self):
        super().__init__()
        self.hashes, self.shapes = [], []
        self.table = (np.zeros(0, np.uint64), np.zeros(0, np.uint8))

    def __missing__(self, word):
        self[word] = number = len(self)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        self.shapes.append(_shape(word))
        return number

    def arrays(self):
        if self.hashes:
            self.table = (
                np.concatenate([self.table[0], np.array(self.hashes, np.uint64)]),
                np.concatenate([self.table[1], np.array(self.shapes, np.uint8)]),
            )
            self.hashes, self.shapes = [], []
        return self.table


def _different(x: np.ndarray) -> np.ndarray:
    """Sorted different numbers; several times as fast as np.unique, which hashes them."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def _words(text: str) -> list[str]:
    return (_ASCII_WORD if text.isascii() else _WORD).findall(text)


def features(texts: list[str], grams: Grams, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number << BITS | feature) sorted and different, and the number of texts' words.

    With `wanted`, a mark for each feature number, only features so marked.
    """
    held = tokens.worker_cache("words")
    known = held.setdefault("words", _Known())
    if len(known) > _HELD:
        known = held["words"] = _Known()
    split = [_words(text.lower() if grams.lower else text) for text in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    at = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
    hashes, shapes = known.arrays()
    words, shapes = hashes[at], shapes[at].astype(np.uint64)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    mask = np.uint64((1 << BITS) - 1)
    found = []

    def add(owner, gram):
        # Number 0 stands for the constant term.
        number = np.maximum(_mix(gram) & mask, np.uint64(1))
        if wanted is not None:
            keep = wanted[number]
            owner, number = owner[keep], number[keep]
        found.append(owner << np.uint64(BITS) | number)

    def joined(values, distance, salt):
        own = text[distance:] == text[:-distance] if len(text) > distance else np.zeros(0, bool)
        left, right = values[: len(values) - distance][own], values[distance:][own]
        return text[distance:][own], _mix(left + np.uint64(salt)) * _ODD + right

    def shares(owner, gram):
        """Each different gram of a text with the bucket of its share."""
        # Owner in the high bits, the gram's mixed hash below: equal pairs meet in a sort.
        key = owner << np.uint64(40) | (_mix(gram) >> np.uint64(24))
        different, n = np.unique(key, return_counts=True)
        who = different >> np.uint64(40)
        total = np.bincount(owner.astype(np.int64), minlength=len(texts))[who.astype(np.int64)]
        bucket = np.digitize(n / total, (0.02, 0.1, 0.3, 0.6)).astype(np.uint64)
        add(who, (different & np.uint64((1 << 40) - 1)) * np.uint64(8) + bucket)

    add(text, words)
    for distance in grams.pairs:
        add(*joined(words, distance, 17 * distance))
    if grams.shapes:
        # A word equal to the one before has a shape of its own.
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
        kind = np.where(same, np.uint64(10), shapes)
        gram = kind
        for n in range(1, grams.shapes + 1):
            if n > 1:
                gram = gram[:-1] * np.uint64(16) + kind[n - 1 :]
            own = text[n - 1 :] == text[: len(text) - n + 1]
            if own.any():
                shares(text[n - 1 :][own], gram[own] * np.uint64(31) + np.uint64(n))
    if grams.repeats and len(text) > 1:
        owner, pair = joined(words, 1, 17)
        if len(owner):
            key = owner << np.uint64(40) | (_mix(pair) >> np.uint64(24))
            different = _different(key) >> np.uint64(40)
            total = np.bincount(owner.astype(np.int64), minlength=len(texts))
            once = np.bincount(different.astype(np.int64), minlength=len(texts))
            some = np.flatnonzero(total)
            bucket = np.digitize(1 - once[some] / total[some], (0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9))
            add(some.astype(np.uint64), bucket.astype(np.uint64) + np.uint64(1 << 50))
    return _different(np.concatenate(found)), counts


def grouped(texts: list[str]):
    """Parts of a list of texts, of bounded size."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size > _GROUP:
            yield part
            part, size = [], 0
    if part:
        yield part


def train(rows: list[tuple[float, np.ndarray]], settings: Settings) -> dict[int, float]:
    """(label, features) in order -> weights that are not 0; number 0 is the constant."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    a, b, l1, l2 = settings.alpha, settings.beta, settings.l1, settings.l2

    def weights(z, n, at):
        sparse = np.where(np.abs(z) <= l1 * (at > 0), 0.0, z - np.sign(z) * l1 * (at > 0))
        return -sparse / ((b + np.sqrt(n)) / a + l2 * (at > 0))

    ones = sum(label for label, _ in rows)
    rare = float(2 * ones < len(rows))
    odds = (len(rows) - ones) / max(ones, 1.0) if rare else ones / max(len(rows) - ones, 1.0)
    more = max(odds, 1.0) ** settings.balance
    for _ in range(settings.epochs):
        for label, at in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni, at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            g *= more if label == rare else 1.0
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / a * w
            n[at] = ni + g * g
    at = np.flatnonzero(z)
    w = weights(z[at], n[at], at)
    return {int(i): float(x) for i, x in zip(at, w) if x}


def calibrated(rows: list[tuple[float, np.ndarray]], settings: Settings) -> dict[int, float]:
    """Train on all rows, with the constant moved to where fewest kept-back rows are wrong.

    The sparse weights of a rare label rank rows well before they are large enough to
    carry many of them over one half. A model of the other rows tells how far to move.
    """
    weights = train(rows, settings)
    kept = rows[:: settings.calibrate]
    others = [row for i, row in enumerate(rows) if i % settings.calibrate]
    part = train(others, settings) if others else {}
    dense = np.zeros(1 << BITS)
    dense[list(part)] = list(part.values())
    margin = np.array([dense[at].sum() for _, at in kept])
    label = np.array([label for label, _ in kept]) > 0
    if label.any() and not label.all():
        order = np.argsort(margin)
        margin, label = margin[order], label[order]
        # Cut k calls the k lowest rows 0: wrong are 1s among them and 0s above, which count
        # FALSE_ALARM times. Of equal cuts the nearest to the trained constant is taken.
        missed = np.concatenate([[0], np.cumsum(label)])
        alarms = np.concatenate([np.cumsum(~label[::-1])[::-1], [0]])
        edges = np.concatenate([[-np.inf], margin, [np.inf]])
        low, high = edges[:-1], edges[1:]
        away = np.maximum(np.maximum(low, -high), 0)
        k = int(np.lexsort([away, missed + FALSE_ALARM * alarms])[0])
        if away[k]:
            middle = (low[k] + high[k]) / 2
            # Beyond the last row: just past it.
            move = middle if np.isfinite(middle) else float(np.clip(0, low[k], high[k]))
            weights[0] = weights.get(0, 0.0) - move
    return weights


def held_out(remainder: int, modulus: int) -> Column:
    """Is crc32 of doc_id, as text, of this remainder? A null doc_id is never held out."""
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % modulus
    return F.coalesce(crc == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, settings: Settings) -> dict[int, float]:
    """Train on labelled documents of doc_id, text for which `learn` holds, one row for each.

    Empty without any such document. Of several texts for one doc_id the largest is taken.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id").agg(F.max(label).cast("double").alias("_label"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .withColumn("_order", F.xxhash64("doc_id"))
        .orderBy("_order", "doc_id").limit(MAX_TRAIN)
    )
    # At most MAX_TRAIN rows.
    sample = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "_order", "_label").agg(F.max("text").alias("text"))
    )
    grams = settings.grams

    def extract(batches):
        for batch in rows.parts(batches, "text"):
            found = []
            for part in grouped(batch.column("text").to_pylist()):
                keys, counts = features(part, grams)
                cuts = np.searchsorted(keys, np.arange(1, len(counts)).astype(np.uint64) << np.uint64(BITS))
                own = (keys & np.uint64((1 << BITS) - 1)).astype("<u4")
                found += [one.tobytes() for one in np.split(own, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_order"), batch.column("_label"), pa.array(found, pa.binary())],
                names=["_order", "_label", "_at"],
            )

    def learn_all(batches):
        rows = []
        for batch in batches:
            for label, at in zip(batch.column("_label").to_pylist(), batch.column("_at").to_pylist()):
                rows.append((label, np.append(0, np.frombuffer(at, "<u4"))))
        learned = calibrated if settings.calibrate else train
        weights = learned(rows, settings) if rows else {}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(weights), pa.int64()), pa.array(list(weights.values()), pa.float64())],
            names=["feature", "weight"],
        )

    found = (
        sample.mapInArrow(extract, "_order long, _label double, _at binary")
        .repartition(1).sortWithinPartitions("_order", "_at")
        .mapInArrow(learn_all, "feature long, weight double")
    )
    return {row.feature: row.weight for row in found.collect()}


def scorer(weights: dict[int, float], grams: Grams):
    """Function from texts to probabilities of label 1; 0.5 for all without training."""
    at, values = np.array(list(weights), np.int64), np.array(list(weights.values()))

    def score(texts: list[str]) -> np.ndarray:
        dense = np.zeros(1 << BITS)
        dense[at] = values
        # Features without a weight add nothing, so they need not be told apart.
        wanted = dense != 0
        out = []
        for part in grouped(texts):
            keys, counts = features(part, grams, wanted)
            own = dense[(keys & np.uint64((1 << BITS) - 1)).astype(np.int64)]
            sums = np.bincount((keys >> np.uint64(BITS)).astype(np.int64), own, len(counts))
            out.append(1 / (1 + np.exp(-np.clip(sums + dense[0], -35, 35))))
        return np.concatenate([*out, np.zeros(0)])

    return score


def scored(docs: DataFrame, weights: dict[int, float], grams: Grams) -> DataFrame:
    """doc_id, text -> doc_id, score."""
    score = scorer(weights, grams)

    def run(batches):
        for batch in rows.parts(batches, "text"):
            found = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def without(docs: DataFrame, weights: dict[int, float], grams: Grams, threshold: float) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below the threshold."""
    score, column = scorer(weights, grams), docs.columns.index("text")

    def run(batches):
        for batch in rows.parts(batches, "text"):
            texts = [text or "" for text in batch.column(column).to_pylist()]
            yield batch.filter(pa.array(score(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
