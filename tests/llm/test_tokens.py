"""Encoding, packing and token files against the tokenizers library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import awkward, table
from tokenizers import Tokenizer

from toolgauge.llm import bpe, files, packing, rans, rows, tokens

BYTE, WORD = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "don't I'll", "<|endoftext|>", " <|endoftext|> x", "x<|startoftext|>",
    "12 3²Ⅷ٣", "é ́", "\x1c\x85\xa0", "汉字 🙂🙂", "A" * 500, "ab" * 400 + " tail", "\x00 ​", "ΣΑΣ İ ß",
]


@pytest.fixture(scope="module")
def data():
    return awkward(2, 60)


@pytest.fixture(scope="module")
def docs(spark, data, tmp_path_factory):
    return table(spark, tmp_path_factory.mktemp("docs") / "documents.parquet", data)


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_is_the_library(path):
    encode = tokens.library_encoder(path)
    reader = Tokenizer.from_file(path)
    texts = ODD + [r[1] or "" for r in awkward(3)]
    for _ in range(2):  # the second time from memory
        assert [list(x) for x in encode(texts)] == [reader.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_of_a_folding_vocabulary_are_encoded_once():
    asked, reader = [], Tokenizer.from_file(WORD)

    def noted(encode):
        return lambda strings: asked.extend(strings) or encode(strings)

    runs, words = tokens.library_runs(WORD), tokens.library_words(WORD)
    encode = tokens.Encoder("noted", tokens.library_pieces(WORD), noted(words), runs=noted(runs))
    text = 'a tree Tree, TREE!! (tree) "tree"\nTree.\ntree élan ÉLAN; oak-tree? don\'t \n x'
    assert list(encode([text])[0]) == reader.encode(text, add_special_tokens=False).ids
    assert asked.count("tree") == asked.count("élan") == 1 and not any("Tree" in one for one in asked)
    assert tokens.library_runs(BYTE) is None


def test_mixed_pieces_are_the_library():
    rng, reader = np.random.default_rng(6), Tokenizer.from_file(WORD)
    bits = ["a", "Tree", "s", "ll", "É", "ß", "ÿ", "œ", "İ", "\u212a", "Σ", "\u0301", "\u0338", "\u200b", "²", "7", "'", "’", "!", "?!"]
    bits += ["(", ".", ",", "-", "=", "<", "<|endoftext|>", "|>", "\n", "\r\n", "\t", "\x0b", "\x1c", "\xa0", " ", "  ", "_", "漢", "가", "ᅡ"]
    texts = ["".join(bits[i] for i in rng.integers(0, len(bits), rng.integers(1, 9))) for _ in range(4000)]
    texts = [f"x {text} y" for text in texts] + texts
    got = tokens.library_encoder(WORD)(texts)
    for text, ids in zip(texts, got):
        assert list(ids) == reader.encode(text, add_special_tokens=False).ids, repr(text)


def test_own_bpe_is_the_library():
    model, reader = bpe.load(BYTE), Tokenizer.from_file(BYTE)
    encode = tokens.Encoder("test", model.strings, model.spaced, 50)
    for text in ODD + [r[1] or "" for r in awkward(4)]:
        ids = reader.encode(text, add_special_tokens=False).ids
        assert list(encode([text])[0]) == ids
        assert model.decode(np.array(ids)) == reader.decode(ids, skip_special_tokens=False)
    broken = np.array([50256, 120, 220, 64, 255, 187])
    assert model.decode(broken) == reader.decode(broken.tolist(), skip_special_tokens=False)


def test_guesses_fail_and_are_mended():
    """Among many words some guesses are wrong: the merges decide."""
    model = bpe.load(BYTE)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdeinorst"), rng.integers(1, 12))).encode() for _ in range(3000)]
    flat, sizes = model.words(words)
    expected = [model.merge(w) for w in words]
    assert flat.tolist() == [i for one in expected for i in one] and sizes.tolist() == list(map(len, expected))
    assert any(model.guess(w) != e for w, e in zip(words, expected))


def test_bpe_round_trip(spark, docs, data):
    got = bpe.decode(bpe.encode(rows.texts(docs), BYTE), BYTE).collect()
    expected = Counter((r[0], r[1] or "", len(library(BYTE, r[1]))) for r in data)
    assert Counter((r.doc_id, r.text, r.n_tokens) for r in got) == expected


def test_packing(spark, docs, data):
    got = packing.pack_documents(rows.texts(docs), BYTE, window=256).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    expected = Counter()
    for r in data:
        ids = np.array([*library(BYTE, r[1]), 1], "<u4")
        for start in range(0, len(ids), 256):
            part = ids[start : start + 256]
            expected[r[0], start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected


def test_plan_uses_all_and_little_room():
    rng = np.random.default_rng(4)
    counts = np.zeros(257, np.int64)
    np.add.at(counts, rng.integers(1, 257, 20_000), 1)
    counts[40] += 9_000  # a third of all have one length
    planned = packing.plan(counts)
    used = np.zeros(257, np.int64)
    for combination, repeats in planned:
        assert sum(combination) <= 256
        np.add.at(used, list(combination), repeats)
    assert (used == counts).all()
    windows = sum(repeats for _, repeats in planned)
    assert windows * 256 <= 1.03 * (counts * np.arange(257)).sum()


def test_least_squares():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 3, (12, 40)).astype(float)
    x = packing.non_negative_least_squares(a, b := rng.random(12) * 10)
    slope = a.T @ (a @ x - b)
    assert (x >= 0).all() and (slope > -1e-6).all() and abs(slope @ x) < 1e-5


def test_token_files(spark, docs, data):
    folder = files.new_folder(spark, "tokens")
    rans.write_documents(rows.texts(docs), WORD, folder)
    got = sorted(rans.read_files(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in data), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    expected = Counter((r[0], tuple(library(WORD, r[1]) + [1])) for r in data)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in got) == expected
    assert all(r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) for r in got)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 5000, (1 << 20) + 7])
def test_blocks(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.4, n) % 49_000).astype(np.uint16)
    table = rans.Table(np.bincount(ids, minlength=1 << 16))
    data = rans.encode_file(3, 7, [(None, 1), (5, n - 1)], ids, table)
    header, found, back = rans.decode_file(data, table)
    assert (back == ids).all() and header["before"] == 7 and found["none"].tolist() == [1, 0]
    damaged = bytearray(data)
    damaged[-2] ^= 1
    with pytest.raises(ValueError):
        rans.decode_file(bytes(damaged), table)


def test_empty_tables(spark, tmp_path):
    none = rows.texts(table(spark, tmp_path / "none.parquet", []))
    assert bpe.encode(none, BYTE).count() == 0
    assert packing.pack_documents(none, BYTE).count() == 0
    folder = files.new_folder(spark, "tokens")
    rans.write_documents(none, WORD, folder)
    assert rans.read_files(spark, folder).count() == 0


def test_round_trip_is_the_library(spark, docs, data):
    """Digests of ids and of the decoded text, as the library makes them."""
    import hashlib

    reader = Tokenizer.from_file(BYTE)
    want = Counter()
    for doc_id, text, *_ in data:
        ids = library(BYTE, text)
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = hashlib.sha256(reader.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want[doc_id, len(ids), coded, decoded] += 1
    assert Counter(map(tuple, bpe.round_trip(rows.texts(docs), BYTE).collect())) == want


def test_names_of_token_files_say_their_sizes(spark, docs, tmp_path, monkeypatch):
    """Several files per part: starts come from the names alone and are gapless."""
    monkeypatch.setattr(rans, "FILE_TOKENS", 500)
    folder = f"file://{tmp_path}/files"
    rans.write_documents(rows.texts(docs), WORD, folder)
    got = sorted(rans.read_files(spark, folder, with_ids=False).collect(), key=lambda r: (r.start, r.n_tokens))
    assert len(list((tmp_path / "files").glob("part-*.rans"))) > len({p.name[:11] for p in (tmp_path / "files").glob("part-*.rans")})
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    for file in (tmp_path / "files").glob("part-000000-*.rans"):
        file.rename(str(file)[:-6] + "9.rans" if str(file)[-6] != "9" else str(file)[:-6] + "8.rans")
    with pytest.raises(Exception, match="the name of a file does not fit"):
        rans.read_files(spark, folder).collect()
