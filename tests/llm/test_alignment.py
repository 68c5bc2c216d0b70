"""Aligned tokens against a restatement byte by byte."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import awkward, table
from tokenizers import Tokenizer

from toolgauge.llm import alignment, rows

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "x\n\ny  z", "don't I'll", "<|endoftext|> <s>", "<0x41> </s>",
    "1234 5²Ⅷ٣", "é ́", "\x1c\x85\xa0", "漢字 🙂🙂x🙂", "A" * 500, "a" * 5001, " " * 777 + "x" + " " * 501, "▁", "k▁k a",
    "\x00 ​", "ΣΑΣ İ ß ﬁ①", "漢" * 300, "\t\ta\r\nb", "a ▁ b",
]
NAMES = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def bytes_of():
    import json

    with open(PATHS[0], encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte, extra = {chr(b): b for b in printable}, 256
    for b in range(256):
        if b not in printable:
            to_byte[chr(extra)] = b
            extra += 1
    a = {i: bytes(map(to_byte.get, name)) for name, i in vocabulary.items() if name != "<|endoftext|>"}
    b_model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    b = {}
    for i in range(b_model.get_piece_size()):
        piece = b_model.id_to_piece(i)
        b[i] = bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()
    a_model = Tokenizer.from_file(PATHS[0])
    a_model.encode_special_tokens = True
    return a_model, a, b_model, b


def restated(texts):
    a_model, a_bytes, b_model, b_bytes = bytes_of()
    documents = []
    for text in texts:
        text = text or ""
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        want = (" " + text).encode()
        if not text or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            documents.append(None)
            continue
        groups, i, j, end_a, end_b = [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            one, two = [], []
            while True:
                if end_a <= end_b and (end_a < end_b or not one):
                    one.append(a[i]), (end_a := end_a + len(a_bytes[a[i]]))
                    i += 1
                elif end_b < end_a or not two:
                    two.append(b[j]), (end_b := end_b + len(b_bytes[b[j]]))
                    j += 1
                if one and two and end_a == end_b:
                    break
            groups.append((one, two))
        documents.append((a, b, groups))
    links = [Counter() for _ in documents]
    for found, document in zip(links, documents):
        for one, two in document[2] if document else ():
            n, m = Counter(one), Counter(two)
            for x in n:
                for y in m:
                    found[x, y] += n[x] * m[y]
    held = Counter(pair for found in links for pair in found)
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for document, found in zip(documents, links):
        if document is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups = document
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(n for pair, n in found.items() if held[pair] == highest[pair[0]])
        sums = sum(n * held[pair] for pair, n in found.items())
        sha = hashlib.sha256(said.encode()).hexdigest()
        out.append((len(a), len(b), len(groups), sum(found.values()), best, sums, sha))
    return out


@pytest.mark.parametrize("block", [None, 300])
def test_alignment(spark, tmp_path, monkeypatch, block):
    """In one block and in many, among awkward texts."""
    data = awkward(13, 60)
    data += [(1000 + i, text, *data[0][2:]) for i, text in enumerate(ODD)]
    docs = rows.texts(table(spark, tmp_path / "documents.parquet", data))
    if block:
        whole = rows.parts
        monkeypatch.setattr(rows, "parts", lambda batches, column, size=0: whole(batches, column, block))
    found = alignment.align(docs, *PATHS).collect()
    want = restated([r[1] for r in data])
    assert Counter((r["doc_id"], *(r[name] for name in NAMES)) for r in found) == Counter(
        (r[0], *one) for r, one in zip(data, want)
    )


def test_pieces_forgotten_long_or_without_spans(monkeypatch):
    """What a worker remembers, and how long a piece is, does not change a layout."""
    texts = [text for text in ODD if text] * 2 + ["漢字 🙂 " * 50]
    want = [list(map(str, part)) for part in alignment.Aligner(*PATHS).documents(texts)]
    for name, value in (("_HELD", 1), ("_LONG", 1), ("_SILENT", 2), ("_PLAIN", 1), ("_JOINED", 3)):
        monkeypatch.setattr(alignment, name, value)
        other = alignment.Aligner(*PATHS)
        for _ in range(3):  # from memory, as far as it goes
            assert [list(map(str, part)) for part in other.documents(texts)] == want


def test_a_long_text(spark):
    """Some MB, with spaces and without."""
    texts = ["many words of ordinary kind, then 漢字 " * 60_000, "ab漢" * 400_000]
    found = alignment.align(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), *PATHS).collect()
    want = restated(texts)
    assert {r["doc_id"]: tuple(r[name] for name in NAMES) for r in found} == dict(enumerate(want))


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, *PATHS).collect() == []
