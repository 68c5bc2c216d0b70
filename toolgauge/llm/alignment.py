"""Tokens of two tokenizers laid side by side, and how often ids meet across a corpus.

Each text is encoded with both: the byte-level one (A) on a space and the text, the sentencepiece
one (B) on the text, which adds the space itself. The character offsets of A's tokens and the
spans of B's pieces are coarse cuts. They are silent inside a character that several tokens share,
and for byte-fallback pieces; there, the bytes that a token stands for tell where it ends. Where
tokens of both end at the same byte, a group ends.

Neither tokenizer has a token across a single space between two other characters, so texts
are cut there and each different piece is laid out once and remembered. The corpus-wide
counts are sums over blocks of documents: a block lists its different id pairs once, with the
number of its documents that hold them, and gets back one count per pair.

Defined results: null text is empty text and has no tokens, like a text whose tokens do not
join to a space and the text again (one that holds U+2581, for B): zeros, an empty groups string. Rows that repeat are rows of their own and count each. Strings of
special tokens are plain text. A null doc_id stays null. A very long piece (no space in a million
characters) is cut by the bytes of its tokens alone, with the same result, and a long group is
counted by its different ids; memory is in proportion to the text. Empty tables give an empty
result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from toolgauge.llm import bpe, rows, tokens
from toolgauge.session import settle

# Bytes of remembered pieces and what is known about them, roughly, after which a worker forgets
# those that were asked for only once; _EACH for every piece besides its texts and pairs.
_HELD = 128 << 20
_EACH = 260
# Pieces of more characters are not remembered.
_LONG = 256
# Pieces of more characters go without offsets.
_SILENT = 1 << 20
# Pieces that are encoded in one call.
_JOINED = 2048
# Links of a group that are written down one by one; beyond, its different ids are counted.
_PLAIN = 1 << 12

# Where a text may be cut, and whether some of its spaces are no such place.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\A\s| \s|\s |\s\Z")


def vocabulary_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file."""
    import json

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    others = [b for b in range(256) if b not in set(bpe.OWN_BYTES)]
    byte = {chr(b): b for b in bpe.OWN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}
    named = content["model"]["vocab"] | {one["content"]: one["id"] for one in content["added_tokens"]}
    out = [b""] * (max(named.values()) + 1)
    for name, i in named.items():
        out[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
    return out


def _runs(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of many runs, one after the other."""
    first = start - (np.cumsum(sizes) - sizes)
    return np.repeat(first, sizes) + np.arange(int(sizes.sum()))


def _table(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all ids: how many, where they start, and all of them one after the other."""
    sizes = np.fromiter(map(len, names), np.int64, len(names))
    return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(names), np.uint8)


class Aligner:
    """Both tokenizers, read from their files, and their layout of strings without context."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = vocabulary_bytes(path_a)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece reaches across a space: texts cannot be cut there")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.table_a, self.table_b = _table(self.bytes_a), _table(self.bytes_b)
        self.names: list[str] = []
        self._new: list[tuple] = []
        self.forget()

    def forget(self) -> None:
        """Start anew with the pieces that were asked for more than once since the last time."""
        kept = [i for i in np.flatnonzero(self.uses >= 2).tolist() if len(self.names[i]) <= _LONG] if self.names else []
        names, facts, flat, said, heavy = (
            ([], np.zeros((0, 6), np.int64), np.zeros(0, np.int64), [], {})
            if not kept
            else (self.names, self.facts, self.flat, self.said, self.heavy)
        )
        at = np.array(kept, np.int64)
        self.names = [names[i] for i in kept]
        self.place = {name: i for i, name in enumerate(self.names)}
        self.said = [said[i] for i in kept]
        # Per piece: tokens of A (-1: none) and B, groups, links, different runs of pairs: start and size.
        self.facts = facts[at]
        self.flat = flat[_runs(self.facts[:, 4], self.facts[:, 5])]
        self.facts[:, 4] = np.cumsum(self.facts[:, 5]) - self.facts[:, 5]
        self.heavy = {i: heavy[k] for i, k in enumerate(kept) if k in heavy}
        self.uses = np.zeros(len(kept), np.int64)
        self.held = sum(map(len, self.said)) + sum(map(len, self.names)) + _EACH * len(kept)

    def spans(self, text: str, at: np.ndarray) -> tuple[tuple, tuple]:
        """For both: ids, where tokens end by their spans, and whether a span says so: inside a
        character it does not. `at` are the bytes before each character of a space and the text."""
        coded = self.a.encode(f" {text}", add_special_tokens=False)
        offsets = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(coded)).reshape(-1, 2)
        # A token that shares its last character with the next one ends inside it.
        clear = np.append(offsets[1:, 0] >= offsets[:-1, 1], True)[: len(offsets)]
        flat = chain.from_iterable((part.id, part.begin, part.end) for part in self.b.encode(text, return_type="proto").pieces)
        ids, begin, end = np.fromiter(flat, np.int64).reshape(-1, 3).T
        # Byte-fallback pieces but the last of a character have empty spans. The space counts.
        return (np.array(coded.ids, np.int64), at[offsets[:, 1]], clear), (ids, end + 1, begin < end)

    def silent(self, text: str) -> tuple[tuple, tuple]:
        """The same without spans."""
        coded = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text, return_type=int)
        return tuple((np.array(ids, np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)) for ids in coded)

    def learn(self, pieces: list[str]) -> None:
        """Lay out new pieces and remember them."""
        plain, alone = [], []
        for piece in pieces:
            if "▁" in piece:
                self._add([piece], None)  # a space to B
            elif len(piece) > _SILENT or piece[0].isspace() or piece[-1].isspace():
                alone.append(piece)
            else:
                plain.append(piece)
        for k in range(0, len(plain), _JOINED):
            chunk = plain[k : k + _JOINED]
            found = self._together(chunk)
            if found is None:
                alone += chunk
            else:
                self._add(chunk, found)
        for piece in alone:
            self._add([piece], self._together([piece]))
        if self._new:
            self.facts = np.concatenate([self.facts, *(facts for facts, _ in self._new)])
            self.flat = np.concatenate([self.flat, *(pairs for _, pairs in self._new)])
            self.facts[:, 4] = np.cumsum(self.facts[:, 5]) - self.facts[:, 5]
            self.uses = np.concatenate([self.uses, np.zeros(len(self.facts) - len(self.uses), np.int64)])
            self._new = []

    def _add(self, pieces: list[str], found: tuple | None) -> None:
        if found is None:
            found = np.tile([-1, 0, 0, 0, 0, 0], (len(pieces), 1)), np.zeros(0, np.int64), [b""] * len(pieces), {}
        facts, pairs, said, heavy = found
        first = len(self.names)
        self.place.update(zip(pieces, range(first, first + len(pieces))))
        self.names += pieces
        self.said += said
        self.heavy.update((first + i, times) for i, times in heavy.items())
        self._new.append((facts, pairs))
        self.held += sum(map(len, said)) + sum(map(len, pieces)) + 8 * len(pairs) + _EACH * len(pieces)

    def _together(self, pieces: list[str]) -> tuple | None:
        """Layout of pieces that can be read as one text; None where its tokens do not make it up."""
        text = " ".join(pieces)
        data = np.frombuffer(f" {text}".encode(), np.uint8)
        codes = np.frombuffer(f" {text}".encode("utf-32-le"), "<u4")
        at = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])
        stops = at[np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)]
        both = self.silent(text) if len(text) > max(_SILENT, 64 * _JOINED) else self.spans(text, at)
        sides = []
        for (ids, coarse, clear), (sizes, place, content) in zip(both, (self.table_a, self.table_b)):
            size = sizes[ids]
            ends = np.cumsum(size)
            if not len(ids) or ends[-1] != len(data) or (content[_runs(place[ids], size)] != data).any():
                return None
            # Spans are coarse cuts; where they are silent, or trimmed, the bytes say where a token ends.
            sides.append((ids, np.where(clear & (coarse == ends), coarse, ends)))
        return self._grouped(sides, stops)

    @staticmethod
    def _grouped(sides, stops) -> tuple:
        """Facts about each piece, its linked id pairs, its groups as text, and for pieces with
        long groups how often each pair is linked."""
        (ids_a, ends_a), (ids_b, ends_b) = sides
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        size_a, size_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        owner = np.searchsorted(stops, cuts)
        product = size_a * size_b
        # Each of A's tokens with the run of B's tokens in its group.
        plain = product <= _PLAIN
        chosen = plain[of_a]
        runs = size_b[of_a[chosen]]
        start_b = np.cumsum(size_b) - size_b
        pairs = [np.repeat(ids_a[chosen], runs) << 32 | ids_b[_runs(start_b[of_a[chosen]], runs)]]
        times, owners = [np.ones(len(pairs[0]), np.int64)], [np.repeat(owner[of_a[chosen]], runs)]
        for group in np.flatnonzero(~plain).tolist():
            a, n = np.unique(ids_a[of_a == group], return_counts=True)
            b, m = np.unique(ids_b[of_b == group], return_counts=True)
            pairs.append((a[:, None] << 32 | b[None, :]).ravel())
            times.append((n[:, None] * m[None, :]).ravel())
            owners.append(np.full(len(pairs[-1]), owner[group]))
        pairs, times, owners = map(np.concatenate, (pairs, times, owners))
        if not plain.all():
            order = np.argsort(owners, kind="stable")
            pairs, times, owners = pairs[order], times[order], owners[order]
        pieces = np.arange(len(stops) + 1)
        pair_at, group_at = np.searchsorted(owners, pieces), np.searchsorted(owner, pieces)
        a_at, b_at = np.concatenate([[0], np.cumsum(size_a)]), np.concatenate([[0], np.cumsum(size_b)])
        links = np.concatenate([[0], np.cumsum(product)])
        facts = np.stack(
            [np.diff(a_at[group_at]), np.diff(b_at[group_at]), np.diff(group_at), np.diff(links[group_at]),
             pair_at[:-1], np.diff(pair_at)], axis=1,
        )
        heavy = {i: times[pair_at[i] : pair_at[i + 1]] for i in np.flatnonzero(facts[:, 3] != facts[:, 5]).tolist()}
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        a_at, b_at, group_at = a_at.tolist(), b_at.tolist(), group_at.tolist()
        said = [f"{','.join(a[i:j])}|{','.join(b[k:m])}" for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])]
        joined = [";".join(said[i:j]).encode() for i, j in zip(group_at, group_at[1:])]
        return facts, pairs, joined, heavy

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: numbers of A's and B's tokens, groups and links; the digest of its groups.
        Per text and different linked pair, in order: number of the text, pair, how often."""
        split = [(_CUT.split(text) if _ODD.search(text) else text.split(" ")) if text else [] for text in texts]
        new = list(dict.fromkeys(chain.from_iterable(split)).keys() - self.place.keys())
        if new:
            self.learn(new)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self.uses += np.bincount(at, minlength=len(self.uses))
        owner = np.repeat(np.arange(len(texts)), counts)
        whole = counts > 0
        whole[owner[self.facts[at, 0] < 0]] = False
        at, owner = at[whole[owner]], owner[whole[owner]]
        totals = np.zeros((len(texts), 4), np.int64)
        if len(at):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            totals[owner[first]] = np.add.reduceat(self.facts[at, :4], first, axis=0)
        begin = np.cumsum(np.where(whole, counts, 0)).tolist()
        numbers = list(map(self.said.__getitem__, at.tolist()))
        hashes = [
            hashlib.sha256(b";".join(numbers[i:j])).hexdigest() if ok else ""
            for i, j, ok in zip([0, *begin], begin, whole.tolist())
        ]
        sizes = self.facts[at, 5]
        linked = self.flat[_runs(self.facts[at, 4], sizes)]
        owners = np.repeat(owner, sizes)
        different, number = np.unique(linked, return_inverse=True)
        if self.heavy and (hot := np.flatnonzero(np.isin(at, list(self.heavy)))).size:
            often, starts = np.ones(len(linked), np.int64), np.cumsum(sizes) - sizes
            for j in hot.tolist():
                often[starts[j] : starts[j] + sizes[j]] = self.heavy[int(at[j])]
            found, where = np.unique(owners * len(different) + number, return_inverse=True)
            times = np.zeros(len(found), np.int64)
            np.add.at(times, where, often)
        else:
            found, times = np.unique(owners * len(different) + number, return_counts=True)
        owners, number = np.divmod(found, max(1, len(different)))
        if self.held > _HELD:
            self.forget()
        return totals, hashes, owners, different[number], times


def load(path_a: str, path_b: str) -> Aligner:
    held = tokens.worker_cache("alignment")
    if (path_a, path_b) not in held:
        held[path_a, path_b] = Aligner(path_a, path_b)
    return held[path_a, path_b]


_BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups_sha256 array<string>, n_pairs array<int>, which binary, times binary, pair array<long>, holders array<long>"
)


def aligned_blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, text -> one row per block of some MB of documents.

    Besides arrays with one entry per document: `pair`, the block's different id pairs
    (a << 32 | b) in order, `holders`, how many of its documents hold each linked, and for each
    document, one after the other, n_pairs places in `pair` and how often each is linked.
    """

    def run(batches):
        aligner = load(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for batch in rows.parts(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            totals, hashes, owner, linked, times = aligner.documents(texts)
            pair, which, holders = np.unique(linked, return_inverse=True, return_counts=True)
            row = [
                block, batch.column("doc_id").to_pylist(), *totals.T, hashes, np.bincount(owner, minlength=len(texts)),
                which.astype("<u4").tobytes(), times.astype("<i8").tobytes(), pair, holders,
            ]
            block += 1
            yield pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(row, arrow)], schema=arrow)

    def lists(kind):
        return pa.list_(kind)

    kinds = [pa.int64()] + [lists(pa.int64())] * 5 + [lists(pa.string()), lists(pa.int32())] + [pa.binary()] * 2
    kinds += [lists(pa.int64())] * 2
    arrow = pa.schema([(part.split()[0], kind) for part, kind in zip(_BLOCKS.split(", "), kinds)])
    return texts.select("doc_id", "text").mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, documents, best (is it the highest count of its A id?), over the whole corpus."""
    held = blocks.select(F.inline(F.arrays_zip("pair", "holders")))
    counted = held.groupBy("pair").agg(F.sum("holders").alias("documents"))
    # One A id meets at most as many others as B has ids.
    same_a = Window.partitionBy(F.shiftright("pair", 32))
    return counted.withColumn("best", F.col("documents") == F.max("documents").over(same_a))


def align(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, text -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = settle(aligned_blocks(texts, path_a, path_b))
    counts = pair_counts(blocks)
    asked = blocks.select("block", F.explode("pair").alias("pair"))
    # A block asks for its own pairs only, each once: as many as its few MB of text hold.
    answers = (
        asked.join(counts, "pair").groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pair", "documents", "best"))).alias("answers"))
        .select("block", F.col("answers.documents").alias("documents"), F.col("answers.best").alias("best"))
    )
    kept = "doc_id n_a n_b n_groups n_links groups_sha256".split()

    def run(batches):
        tokens.worker_cache("none")  # what the first pass remembered
        for batch in batches:
            for row in chain.from_iterable(batch.slice(k, 1).to_pylist() for k in range(batch.num_rows)):
                owner = np.repeat(np.arange(len(row["doc_id"])), row["n_pairs"])
                which, times = np.frombuffer(row["which"], "<u4"), np.frombuffer(row["times"], "<i8")
                documents = np.array(row["documents"] or [], np.int64)
                best = np.array(row["best"] or [], np.int64)
                sums = {}
                for name, values in (("n_best", best), ("count_sum", documents)):
                    sums[name] = np.zeros(len(row["doc_id"]), np.int64)
                    np.add.at(sums[name], owner, times * values[which])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(row[name], pa.string() if name == "groups_sha256" else pa.int64()) for name in kept),
                     *map(pa.array, sums.values())],
                    names=[*kept, *sums],
                )

    out = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in [*kept, "n_best", "count_sum"])
    joined = blocks.drop("pair", "holders").join(answers, "block", "left")
    return joined.mapInArrow(run, out).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
