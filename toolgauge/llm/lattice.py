"""Probability of a text over all its segmentations into the pieces of a vocabulary.

A word, with the space before it, is a lattice: every piece of a public vocabulary file that
matches between two of its bytes is an arc, single bytes always are. The marginal probability
of the word is the sum over all paths, by forward recursion in log space, for many words of
one length at a time. The scores of the pieces start from the file's own order and are
re-estimated here by expectation maximisation over the different words of the training texts.

Words that training saw are further entries of the vocabulary: an arc over the whole word with
its count less an absolute discount; the pieces share what the discount frees. This keeps the
sum over all words, and the end of a text, at 1.

Scale: tasks fold each block of documents to its different words before anything is shuffled,
so a frequent word costs one row per block. Words are counted and scored once each, and go back
to their blocks by a join; documents are added up block by block. Only the pieces' scores
(bounded by the vocabulary) pass through the driver.

Defined results: null or empty text has the end token alone. A null doc_id stays null and its
text is learned from. Rows that repeat count as often as they come. Without training texts the
end token has probability 1 / 2. An empty table gives an empty result. Columns besides doc_id
and text are not looked at.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from toolgauge.llm import rows, tokens
from toolgauge.llm.ftrl import held_out
from toolgauge.session import settle

EM_ROUNDS = 3
# Added to the expected count of each piece.
SMOOTHING = 0.01
_PRIME = np.uint64(0x100000001B3)
# Words longer than this are handled one at a time.
_LONG = 64


def pieces(path: str) -> list[bytes]:
    """The byte strings of a sentencepiece file in its order, then missing single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, None] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            found[model.id_to_piece(i).replace("▁", " ").encode()] = None
    found.update((bytes([b]), None) for b in range(256))
    return list(found)


def order_scores(size: int) -> np.ndarray:
    """Natural logs of probabilities by rank: the file lists frequent pieces first."""
    weights = 1 / np.arange(2, size + 2)
    return np.log(weights / weights.sum())


def _hashes(words: np.ndarray) -> np.ndarray:
    """Rows of bytes -> polynomial hashes of all their prefixes."""
    out = np.zeros((words.shape[0], words.shape[1] + 1), np.uint64)
    for i in range(words.shape[1]):
        out[:, i + 1] = out[:, i] * _PRIME + words[:, i] + np.uint64(1)
    return out


class Vocabulary:
    """Pieces by hash; finds the arcs of many words of one length at once."""

    def __init__(self, names: list[bytes]):
        self.names = {name: i for i, name in enumerate(names)}
        self.longest = max(map(len, names))
        hashes = np.zeros(len(names), np.uint64)
        for i, name in enumerate(names):
            hashes[i] = _hashes(np.frombuffer(name, np.uint8)[None])[0, -1]
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.lengths = set(map(len, names))

    def arcs(self, words: list[bytes]):
        """Words of one length -> (start, end, rows, pieces) for every span that has any."""
        table = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)
        prefix, length = _hashes(table), table.shape[1]
        power = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(length):
                power.append(power[-1] * _PRIME)
        for end in range(1, length + 1):
            for size in range(1, min(end, self.longest) + 1):
                if size not in self.lengths:
                    continue
                key = prefix[:, end] - prefix[:, end - size] * power[size]
                at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
                hit = np.flatnonzero(self.sorted[at] == key)
                if len(hit):
                    yield end - size, end, hit, self.order[at[hit]]


def marginals(words: list[bytes], vocabulary: Vocabulary, scores: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability over all segmentations."""
    out = np.empty(len(words))
    for at, part in _by_length(words):
        if len(part[0]) > _LONG:
            out[at] = [_one(word, vocabulary, scores)[0][-1] for word in part]
            continue
        forward = np.full((len(part), len(part[0]) + 1), -np.inf)
        forward[:, 0] = 0
        for start, end, hit, piece in vocabulary.arcs(part):
            forward[hit, end] = np.logaddexp(forward[hit, end], forward[hit, start] + scores[piece])
        out[at] = forward[:, -1]
    return out


def expected(words: list[bytes], vocabulary: Vocabulary, scores: np.ndarray) -> np.ndarray:
    """How often each piece occurs in the words, in expectation over their segmentations."""
    totals = np.zeros(len(scores))
    for _, part in _by_length(words):
        if len(part[0]) > _LONG:
            for word in part:
                forward, backward, arcs = _one(word, vocabulary, scores, both=True)
                for start, end, piece in arcs:
                    totals[piece] += math.exp(forward[start] + scores[piece] + backward[end] - forward[-1])
            continue
        arcs = list(vocabulary.arcs(part))
        forward = np.full((len(part), len(part[0]) + 1), -np.inf)
        backward = forward.copy()
        forward[:, 0] = backward[:, -1] = 0
        for start, end, hit, piece in arcs:
            forward[hit, end] = np.logaddexp(forward[hit, end], forward[hit, start] + scores[piece])
        for start, end, hit, piece in reversed(arcs):
            ahead = backward[hit, end] + scores[piece]
            backward[hit, start] = np.logaddexp(backward[hit, start], ahead)
        for start, end, hit, piece in arcs:
            share = forward[hit, start] + scores[piece] + backward[hit, end] - forward[hit, -1]
            totals += np.bincount(piece, np.exp(share), len(totals))
    return totals


def _by_length(words: list[bytes]):
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for at in groups.values():
        yield at, [words[i] for i in at]


def _one(word: bytes, vocabulary: Vocabulary, scores: np.ndarray, both: bool = False):
    """Forward (and backward) logs of a single long word, and its arcs."""
    n, arcs = len(word), []
    forward = [0.0] + [-math.inf] * n
    for end in range(1, n + 1):
        sums = []
        for start in range(max(0, end - vocabulary.longest), end):
            piece = vocabulary.names.get(word[start:end])
            if piece is not None:
                sums.append(forward[start] + scores[piece])
                if both:
                    arcs.append((start, end, piece))
        forward[end] = float(np.logaddexp.reduce(sums))
    backward = [-math.inf] * n + [0.0]
    for start, end, piece in reversed(arcs):
        backward[start] = float(np.logaddexp(backward[start], scores[piece] + backward[end]))
    return forward, backward, arcs


def _vocabulary(path: str) -> Vocabulary:
    held = tokens.worker_cache("lattice")
    if ("lattice", path) not in held:
        held["lattice", path] = Vocabulary(pieces(path))
    return held["lattice", path]


_BLOCKS = (
    "block long, doc_id long, held_out boolean, n_words long, at binary, times binary,"
    " number int, word binary, train long"
)


def blocks(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, text -> per Arrow batch: rows of documents and rows of different words.

    A document row has its words as numbers inside the block and how often each occurs; a
    word row has its number and its count in documents to learn from.
    """
    kinds = [
        pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(),
        pa.int32(), pa.binary(), pa.int64(),
    ]
    names = [part.split()[0] for part in _BLOCKS.split(", ")]

    def table(block, size, **columns):
        columns["block"] = [block] * size
        arrays = [pa.array(columns[n], k) if n in columns else pa.nulls(size, k) for n, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        number = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            block, place = next(number), tokens._Places()
            train = np.zeros(1 << 16, np.int64)
            for part in rows.parts([batch], "text"):
                held, n, at, times = part.column("held_out").to_pylist(), [], [], []
                for text, out in zip(part.column("text").to_pylist(), held):
                    words = text.lower().split()
                    found = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    different, often = np.unique(found, return_counts=True)
                    if place.count > len(train):
                        train = np.concatenate([train, np.zeros(place.count, np.int64)])
                    if not out:
                        train[different] += often
                    n.append(len(words))
                    at.append(different.astype("<u4").tobytes())
                    times.append(often.astype("<u4").tobytes())
                yield table(
                    block, len(n), doc_id=part.column("doc_id").to_pylist(), held_out=held, n_words=n, at=at, times=times
                )
            words = list(place)
            for k in range(0, len(words), 50_000):
                some = words[k : k + 50_000]
                yield table(block, len(some), number=range(k, k + len(some)), word=some, train=train[k : k + len(some)])

    return docs.select("doc_id", "held_out", F.col("text").cast("binary").alias("text")).mapInArrow(run, _BLOCKS)


def learn(words: DataFrame, path: str, em_rounds: int = EM_ROUNDS) -> np.ndarray:
    """word (settled, different ones of the training texts) -> natural-log scores of the pieces."""
    size = len(pieces(path))
    scores = order_scores(size)
    for _ in range(em_rounds):

        def run(batches, scores=scores):
            totals, vocabulary = np.zeros(size), _vocabulary(path)
            for batch in batches:
                totals += expected([b" " + w for w in batch.column("word").to_pylist()], vocabulary, scores)
            at = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at])], names=["piece", "n"])

        found = words.select("word").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        totals = np.full(size, SMOOTHING)
        for row in found.collect():  # at most one row per piece of the vocabulary
            totals[row.piece] += row.n
        scores = np.log(totals / totals.sum())
    return scores


def _word_scores(counted: DataFrame, path: str, scores: np.ndarray, facts: dict) -> DataFrame:
    """word, c -> word, c, log10 probability."""
    d, types, n = facts["discount"], facts["types"], facts["n"]

    def run(batches):
        vocabulary = _vocabulary(path)
        for batch in batches:
            seen = batch.column("c").to_numpy().astype(float)
            lattice = marginals([b" " + w for w in batch.column("word").to_pylist()], vocabulary, scores)
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(seen - d, 0))
            p = np.logaddexp(whole, math.log(d * types + 0.5) + lattice) - math.log(n + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(p / math.log(10))], names=["word", "c", "p"]
            )

    return counted.mapInArrow(run, "word binary, c long, p double")


def score(docs: DataFrame, path: str, em_rounds: int = EM_ROUNDS) -> DataFrame:
    """doc_id, text -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    both = settle(blocks(docs.select("doc_id", "text", held_out(2, 7).alias("held_out"))))
    texts = both.filter("word IS NULL").select("block", "doc_id", "held_out", "n_words", "at", "times")
    words = both.filter("word IS NOT NULL").select("block", "number", "word", "train")
    counted = settle(words.groupBy("word").agg(F.sum("train").alias("c")))
    trained = counted.filter("c > 0")
    row = trained.agg(
        F.count("*").alias("types"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    ends = texts.filter("NOT held_out").count()
    n, kinds = int(row.n) + ends, int(row.types) + (ends > 0)
    discount = min(0.9, max(0.1, row.once / (row.once + 2 * row.twice) if row.once else 0.5))
    facts = {"discount": discount, "types": int(row.types), "n": n}
    found = _word_scores(counted, path, learn(trained, path, em_rounds), facts)
    own = words.select(F.col("block").alias("owner"), "number", "word")
    back = own.join(found, "word").select("owner", "number", "c", "p")
    end_score, end_base = math.log10((ends + 0.5) / (n + 1)), math.log10((ends + 1) / (n + kinds + 1))

    def add_up(left, right):
        number = right.column("number").to_numpy()
        p, c = np.zeros(len(number)), np.zeros(len(number), np.int64)
        p[number], c[number] = right.column("p").to_numpy(), right.column("c").to_numpy()
        base = np.log10((c + 1) / (n + kinds + 1))
        known, sums, bases = [], [], []
        for at, times in zip(left.column("at").to_pylist(), left.column("times").to_pylist()):
            at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4")
            known.append(int(times[c[at] > 0].sum()) + (ends > 0))
            sums.append(float(times @ p[at]) + end_score)
            bases.append(float(times @ base[at]) + end_base)
        size = left.num_rows
        return pa.table(
            {
                "doc_id": left.column("doc_id"), "held_out": left.column("held_out"),
                "n_tokens": pa.array(left.column("n_words").to_numpy() + 1, pa.int64()),
                "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([n] * size, pa.int64()),
                "base_score": pa.array(bases, pa.float64()), "score": pa.array(sums, pa.float64()),
            }
        )

    return (
        texts.groupBy("block").cogroup(back.groupBy("owner"))
        .applyInArrow(
            add_up,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
            " base_score double, score double",
        )
    )
