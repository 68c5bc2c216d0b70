"""Importance resampling against a restatement word by word."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_cases import awkward, table

from toolgauge.llm import resampling, rows

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    data = (text or "").encode()
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in data))
    return words, [b" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def restated(data, target, runs, buckets, percent, least):
    def bucket(feature):
        return zlib.crc32(feature) % buckets

    corpus = Counter(bucket(f) for _, text in data for f in features(text, runs)[1])
    wanted = Counter(bucket(f) for text in target for f in features(text, runs)[1])
    S, T = corpus.total(), wanted.total()
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1.0) * (S + buckets) / ((corpus[b] + 1.0) * (T + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc_id, text in data:
        words, found = features(text, runs)
        weight = math.floor(sum(gain[bucket(f)] for f in found) / len(found)) if found else 0
        name = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words) >= least])
    eligible = sorted(
        (row for row in out if row[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1])
    )
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return Counter(tuple(row[:5]) for row in out)


@pytest.mark.parametrize("runs, buckets, most", [(1, 10_000, 1 << 16), (2, 10_000, 40), (2, 7, 1 << 16), (3, 65_536, 3)])
def test_draw(spark, tmp_path, monkeypatch, runs, buckets, most):
    """Heads that hold all words, some, and few give the same exact totals."""
    data = awkward(12)
    docs = table(spark, tmp_path / "documents.parquet", data)
    target = ["the abc Words of long text", None, "", "same words\nword word x", "ABC éé 1a2"]
    wanted = spark.createDataFrame(list(enumerate(target)), "doc_id long, text string")
    head = resampling.head_of
    monkeypatch.setattr(resampling, "head_of", lambda texts, runs, buckets: head(texts, runs, buckets, most))
    found = resampling.draw(rows.texts(docs), rows.texts(wanted), runs, buckets, percent=35, least_words=3)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == restated([r[:2] for r in data], target, runs, buckets, 35, 3)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert resampling.draw(empty, one).collect() == []
    found = resampling.draw(one, empty, percent=100, least_words=2).collect()
    assert Counter(map(tuple, found)) == restated([(1, "a b")], [], 1, 10_000, 100, 2)


def test_a_long_text(spark):
    texts = [(1, "Some words, other words. " * 200_000), (2, "x" * 5_000_000)]
    found = resampling.draw(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(1, "words")], "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == restated(texts, ["words"], 1, 10_000, 10, 20)


def test_buckets_fit():
    with pytest.raises(ValueError):
        resampling.draw(None, None, buckets=1 << 17)
