"""Texts to token ids with a public tokenizer file, by remembering words.

Splitting a text at each single space that stands between two other characters cannot
change its tokens: no token spans such a space except as its first character. Each piece
is therefore encoded once per worker and looked up from then on. Texts in which a space
touches other white space, or that hold a very long piece, are encoded whole.

A vocabulary that drops white space, folds case and cuts between letters and marks needs less:
a piece of Latin letters and marks is put together from its runs, each encoded once.
"""

from __future__ import annotations

import json
import re
import sys
from itertools import chain
from operator import itemgetter

import numpy as np

# Pieces longer than this are encoded but not remembered.
_LONG = 64
# A worker forgets its pieces when they take about this many bytes, with _EACH for every one
# besides its characters.
_HELD = 224 << 20
_EACH = 140
# New words in one call.
_JOINED = 2048
# Characters that are looked up together.
_GROUP = 1 << 21
# What may be cut into runs: no apostrophe, which may start a token of letters, nothing that
# composes with a neighbour, and no mark that an added token has.
_PLAIN = re.compile(r'[A-Za-zÀ-ÖØ-öø-ÿ!"(),.:;?\t\n\r-]*')
_RUN = re.compile(r'[a-zß-öø-ÿ]+|[!"(),.:;?-]+')
# How a tokenizer file says that it cuts at these runs and ends each with _END.
_FOLDED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "</w>"


def worker_cache(kind: str = "tokens") -> dict:
    """A dictionary that lives in the Python worker until another kind of work asks for one.

    Workers outlive stages; what one stage remembered must not add to the next one's memory.
    """
    held = sys.__dict__.setdefault("_toolgauge_llm", {})
    if held.get("kind") != kind:
        held.clear()
        held["kind"] = kind
    return held


def tokenizer(path: str):
    """The tokenizers library's reading of a file, one per worker, on one thread."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    held = worker_cache()
    if path not in held:
        loaded = Tokenizer.from_file(path)
        loaded.no_padding()
        loaded.no_truncation()
        if loaded.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError(f"ids of {path} do not fit in 16 bits")
        held[path] = loaded
    return held[path]


def library_pieces(path: str):
    """Function from a list of strings to (ids of all, number of ids of each)."""

    def encode(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer(path).encode_batch_fast(strings, add_special_tokens=False)
        sizes = np.fromiter((len(one) for one in found), np.int32, len(strings))
        flat = np.fromiter(chain.from_iterable(one.ids for one in found), np.uint16, int(sizes.sum()))
        return flat, sizes

    return encode


def library_words(path: str):
    """The same for strings to be read after a space, with no white space at either end.

    They are joined, since a call for each of many short strings costs more than their
    tokens. A token belongs to the string in which it starts.
    """

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int32)]
        for k in range(0, len(words), _JOINED):
            part = words[k : k + _JOINED]
            found = tokenizer(path).encode(" " + " ".join(part), add_special_tokens=False)
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
            flat.append(np.array(found.ids, np.uint16))
            begin = np.fromiter(map(itemgetter(0), found.offsets), np.int64, len(flat[-1]))
            cuts = np.searchsorted(begin, np.cumsum(lengths), side="left")
            sizes.append(np.diff(cuts, prepend=0).astype(np.int32))
        return np.concatenate(flat), np.concatenate(sizes)

    return encode


def folded_runs(piece: str) -> list[str] | None:
    """The runs of a piece in lower case, without white space; None if it holds anything else."""
    return _RUN.findall(piece.lower()) if _PLAIN.fullmatch(piece) else None


def library_runs(path: str):
    """Like library_words, for single runs of a vocabulary that marks their ends; None for others.

    Cutting by the marks needs no offsets from the library: 4.2 instead of 7.0 µs a word.
    """
    held = worker_cache()
    if ("ends", path) not in held:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, normalizer, cuts = spec["model"], spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        first, *rest = cuts.get("pretokenizers", [{}])
        same = (
            normalizer.get("normalizers") == _FOLDED
            and (first.get("pattern"), first.get("behavior"), first.get("invert")) == ({"Regex": _CUT}, "Removed", True)
            and [(one["type"], one.get("add_prefix_space"), one.get("use_regex")) for one in rest] == [("ByteLevel", False, False)]
            and (model["type"], model.get("end_of_word_suffix")) == ("BPE", _END)
            and not model.get("continuing_subword_prefix") and not model.get("dropout")
            and all(folded_runs(one["content"]) is None for one in spec["added_tokens"])
        )
        ends = np.zeros(1 << 16, bool)
        ends[[number for token, number in model["vocab"].items() if token.endswith(_END)]] = True
        held["ends", path] = ends if same else None
    ends = held["ends", path]
    if ends is None:
        return None

    def encode(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int32)]
        for k in range(0, len(runs), _JOINED):
            part = runs[k : k + _JOINED]
            found = tokenizer(path).encode_batch_fast([" ".join(part)], add_special_tokens=False)
            flat.append(np.array(found[0].ids, np.uint16))
            last = np.flatnonzero(ends[flat[-1]])
            if len(last) != len(part):
                raise ValueError("this vocabulary does not end each run with a mark")
            sizes.append(np.diff(last, prepend=-1).astype(np.int32))
        return np.concatenate(flat), np.concatenate(sizes)

    return encode


def _runs(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of many runs, one after the other."""
    first = start - (np.cumsum(sizes) - sizes)
    return np.repeat(first, sizes) + np.arange(int(sizes.sum()))


class _Places(dict):
    """Numbers for pieces; an unknown one gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.count, self.new = 0, []

    def __missing__(self, piece):
        self[piece] = number = self.count
        self.count += 1
        self.new.append(piece)
        return number


class Encoder:
    """Token ids of whole texts.

    `strings` and `words` encode as library_pieces and library_words do; `runs` as library_runs,
    where the vocabulary allows.
    """

    def __init__(self, key: str, strings, words, most: int = _HELD, runs=None):
        self.strings, self.words, self.most, self.runs = strings, words, most, runs
        self.held = worker_cache().setdefault(("pieces", key), {})
        if not self.held:
            self._forget()
            # What _learn takes as given about commas and full stops.
            flat, sizes = strings(["a,", "é.", "z.", "a", ",", "é", ".", "z", "."])
            first = int(sizes[:3].sum())
            if flat[:first].tolist() != flat[first:].tolist():
                raise ValueError("this vocabulary joins letters and punctuation")

    def _forget(self) -> None:
        # Pieces are keyed by themselves; one that starts a text by a tuple of itself.
        self.held.update(
            place=_Places(), used=0, bytes=0, flat=np.zeros(1 << 20, np.uint16),
            start=np.zeros(1 << 16, np.int64), size=np.zeros(1 << 16, np.int32),
        )

    def _room(self, name: str, need: int) -> np.ndarray:
        array = self.held[name]
        if need > len(array):
            longer = np.zeros(max(need, 2 * len(array)), array.dtype)
            longer[: len(array)] = array
            self.held[name] = array = longer
        return array

    def _learn(self) -> None:
        """Encode the new pieces; those at which a text must not be cut get the size -1.

        A comma or full stop after a letter is a token of its own, so a piece that ends in
        one takes its ids from the piece without it. With `runs`, a piece takes those of its
        runs instead.
        """
        held = self.held
        place = held["place"]
        words, starts, at_words, at_starts, stops = [], [], [], [], []
        runs, at_runs, made, of = [], [], [], []
        held["bytes"] += sum(map(len, place.new)) + _EACH * len(place.new)
        begin = place.count - len(place.new)
        known = len(place.new)
        for number, piece in enumerate(place.new, begin):  # grows by stems and runs that are new
            if type(piece) is tuple:
                if not piece[0][-1:].isspace() and len(piece[0]) <= _LONG:
                    starts.append(piece[0])
                    at_starts.append(number)
                del place[piece]
            elif len(piece) > _LONG:
                del place[piece]
            elif self.runs and piece.isascii() and piece.isalpha() and piece.islower():
                runs.append(piece)
                at_runs.append(number)
            elif self.runs and (parts := folded_runs(piece)) is not None:
                if parts == [piece]:
                    runs.append(piece)
                    at_runs.append(number)
                else:
                    made.append(number)
                    of.append([place[part] for part in parts])
            elif piece and not (piece[0].isspace() or piece[-1].isspace()):
                # Folding can leave an accent after a letter, which joins the mark: İ, is not İ and a comma.
                if not self.runs and piece[-1] in ",." and piece[-2:-1].isalpha():
                    stops.append((number, place[piece[:-1]], piece[-1]))
                else:
                    words.append(piece)
                    at_words.append(number)
        if self.runs:
            held["bytes"] += sum(map(len, place.new[known:])) + _EACH * (len(place.new) - known)
        place.new = []
        size, start = self._room("size", place.count), self._room("start", place.count)
        size[begin : place.count] = -1
        for encode, part, numbers in ((self.words, words, at_words), (self.strings, starts, at_starts)):
            self._keep(numbers, *encode(part))
        if runs:
            self._keep(at_runs, *self.runs(runs))
        if made:
            counts = np.fromiter(map(len, of), np.int64, len(of))
            parts = np.fromiter(chain.from_iterable(of), np.int64, int(counts.sum()))
            flat = held["flat"][_runs(start[parts], size[parts])]
            ends = np.cumsum(size[parts], dtype=np.int64)
            sizes = np.diff(np.concatenate([[0], ends])[np.cumsum(counts)], prepend=0)
            self._keep(made, flat, sizes)
        if stops:
            numbers, stems, marks = (np.array(column) for column in zip(*stops))
            mark = dict(zip(",.", self.strings([",", "."])[0]))
            sizes = size[stems] + 1
            flat = held["flat"][_runs(start[stems], sizes)]
            flat[np.cumsum(sizes) - 1] = np.where(marks == ",", mark[","], mark["."])
            self._keep(numbers, flat, sizes)

    def _keep(self, numbers, flat: np.ndarray, sizes: np.ndarray) -> None:
        used = self.held["used"]
        # One more than needed: a run that is read with a place for its mark stays inside.
        self._room("flat", used + len(flat) + 1)[used : used + len(flat)] = flat
        self.held["size"][numbers] = sizes
        self.held["start"][numbers] = used + np.cumsum(sizes) - sizes
        self.held["used"] = used + len(flat)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """One uint16 array of ids per text."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > _GROUP:
                out += self._together(group)
                group, size = [], 0
        return out + self._together(group)

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if self.held["bytes"] > self.most:
            self._forget()
        held = self.held
        split = [text.split(" ") for text in texts]
        for pieces in split:
            pieces[0] = (pieces[0],)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(
            map(held["place"].__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum())
        )
        if held["place"].new:
            self._learn()
        sizes = held["size"][at]
        begin = np.cumsum(counts) - counts
        whole = np.minimum.reduceat(sizes, begin) < 0
        sizes = np.maximum(sizes, 0)
        ids = held["flat"][_runs(held["start"][at], sizes)]
        out = np.split(ids, np.cumsum(np.add.reduceat(sizes, begin))[:-1])
        for i in np.flatnonzero(whole):
            out[i] = self.strings([texts[i]])[0]
        return out


def library_encoder(path: str) -> Encoder:
    """Token ids as the tokenizers library gives them without special tokens added."""
    return Encoder(path, library_pieces(path), library_words(path), runs=library_runs(path))
