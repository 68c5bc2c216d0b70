"""Byte-level BPE, encoded by guessing and checking, and decoded.

A sequence of tokens is what BPE makes of a word exactly when each two neighbours are what
BPE makes of their joined bytes (and each token of its own). So a word is first cut
greedily into the longest tokens; the neighbours of all words of a batch are then checked
as one array of pairs, each different pair once; only words with a pair that fails go
through the merges one by one.

Defined results: null text is empty text: no ids, and empty text back. Rows that repeat
are encoded alike; a null doc_id stays null. An empty table gives an empty result. Strings
of added tokens inside a text become their ids, as the tokenizers library does by default.
Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from toolgauge.llm import rows, tokens

# Fixed values of byte-level BPE: how texts fall into words, and the bytes that stand for
# themselves in a vocabulary file (the others are counted up from 256).
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
OWN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))

# Checked pairs that a worker remembers (some 130 bytes each).
_PAIRS = 250_000
# Bytes of pieces of texts that a worker remembers.
_HELD = 80 << 20


class Bpe:
    """A vocabulary file: encode words (bytes) to ids, decode ids to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        others = [b for b in range(256) if b not in set(OWN_BYTES)]
        byte = {chr(b): b for b in OWN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}
        self.added = {one["content"]: one["id"] for one in content["added_tokens"]}
        names = {i: bytes(byte[c] for c in name) for name, i in model["vocab"].items() if name not in self.added}
        self.bytes = [names.get(i, b"") for i in range(max(*names, *self.added.values()) + 1)]
        for name, i in self.added.items():
            self.bytes[i] = name.encode()
        if len(self.bytes) > 1 << 16:
            raise ValueError(f"ids of {path} do not fit in 16 bits")
        numbers = {name: i for i, name in names.items()}
        self.single = [numbers[bytes([b])] for b in range(256)]
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(byte[c] for c in part) for part in (a, b))
            self.merges[numbers[a], numbers[b]] = (rank, numbers[a + b])
        # Tokens that BPE makes of their own bytes; no others can be the result for a word.
        self.tokens = {name: i for name, i in numbers.items() if self.merge(name) == [i]}
        self.longest = max(map(len, self.tokens))
        self.fits: dict[int, bool] = {}
        self.word = regex.compile(WORDS)
        names = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def merge(self, word: bytes) -> list[int]:
        """The merges themselves: the lowest rank first, leftmost among equals."""
        ids = [self.single[b] for b in word]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        get = self.merges.get
        heap = [(*found, i) for i in range(len(ids) - 1) if (found := get((ids[i], ids[i + 1])))]
        heap = [(rank, i, made) for rank, made, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := get((made, ids[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := get((ids[h], made))):
                heapq.heappush(heap, (found[0], h, found[1]))
        return [i for i in ids if i >= 0]

    def guess(self, word: bytes) -> list[int]:
        """Always the longest token that comes next."""
        out, at, end, get = [], 0, len(word), self.tokens.get
        while at < end:
            stop = min(end, at + self.longest)
            while (found := get(word[at:stop])) is None:
                stop -= 1
            out.append(found)
            at = stop
        return out

    def fitting(self, pairs: np.ndarray) -> np.ndarray:
        """For pairs (first << 32 | second): does BPE leave them as they are?"""
        different, where = np.unique(pairs, return_inverse=True)
        if len(self.fits) > _PAIRS:
            self.fits.clear()
        fits = self.fits
        for pair in different.tolist():
            if pair not in fits:
                a, b = pair >> 32, pair & 0xFFFFFFFF
                fits[pair] = self.merge(self.bytes[a] + self.bytes[b]) == [a, b]
        known = np.fromiter(map(fits.__getitem__, different.tolist()), bool, len(different))
        return known[where]

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        guesses = list(map(self.guess, words))
        sizes = np.fromiter(map(len, guesses), np.int64, len(words))
        flat = np.fromiter((i for one in guesses for i in one), np.int64, int(sizes.sum()))
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), sizes)
            inside = owner[1:] == owner[:-1]
            pairs = (flat[:-1] << 32 | flat[1:])[inside]
            wrong = np.unique(owner[1:][inside][~self.fitting(pairs)])
            if len(wrong):
                for k in wrong.tolist():
                    guesses[k] = self.merge(words[k])
                sizes = np.fromiter(map(len, guesses), np.int64, len(words))
                flat = np.fromiter((i for one in guesses for i in one), np.int64, int(sizes.sum()))
        return flat, sizes

    def strings(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole strings, added tokens and all."""
        words, owner, special = [], [], []
        for k, text in enumerate(strings):
            for part in self.split.split(text) if self.split else [text]:
                if part in self.added:
                    special.append((len(words), self.added[part]))
                    words.append(b"")
                    owner.append(k)
                else:
                    found = self.word.findall(part)
                    words += [w.encode("utf-8") for w in found]
                    owner += [k] * len(found)
        flat, sizes = self.words(words)
        if special:
            at = np.cumsum(sizes) - sizes
            flat = np.insert(flat, [at[i] for i, _ in special], [i for _, i in special])
            for i, _ in special:
                sizes[i] = 1
        owner = np.array(owner, np.int64)
        return flat.astype(np.uint16), np.bincount(owner, sizes, len(strings)).astype(np.int32)

    def spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings read after a space, with no white space at either end."""
        return self.strings([f" {word}" for word in words])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def load(path: str) -> Bpe:
    held = tokens.worker_cache()
    key = ("bpe", path)
    if key not in held:
        held[key] = Bpe(path)
    return held[key]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text -> doc_id, n_tokens, ids (unsigned 32-bit little-endian integers)."""

    def run(batches):
        model = load(path)
        encoder = tokens.Encoder(f"own {path}", model.strings, model.spaced, _HELD)
        for batch in rows.parts(batches, "text"):
            found = encoder(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array([ids.astype("<u4").tobytes() for ids in found], pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids -> the same with `text`."""

    def run(batches):
        model = load(path)
        for batch in rows.parts(batches, "ids"):
            texts = [model.decode(np.frombuffer(ids, "<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
            )

    return coded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text -> doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes in one pass; only the digests leave the task.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        model = load(path)
        encoder = tokens.Encoder(f"own {path}", model.strings, model.spaced, _HELD)
        for batch in rows.parts(batches, "text"):
            found = encoder(batch.column("text").to_pylist())
            coded = [hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in found]
            decoded = [hashlib.sha256(model.decode(ids).encode()).hexdigest() for ids in found]
            sizes = pa.array(list(map(len, found)), pa.int64())
            columns = [batch.column("doc_id"), sizes, pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
