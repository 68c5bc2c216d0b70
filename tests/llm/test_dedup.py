"""Exact and near duplicates against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import awkward, near_components, table

from toolgauge.llm import components, exact_dedup, minhash, weak_rules


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    return table(spark, tmp_path_factory.mktemp("docs") / "documents.parquet", rows)


def squeezed(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "\n\na\tb \x0b", "\xa0 é\x1cé", "\x85"])
def test_squeezed(text):
    assert exact_dedup.squeezed(text.encode()).decode() == squeezed(text)


def test_exact(spark, docs, rows):
    ids = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids[squeezed(text)].append(doc_id)
    expected = Counter(
        (
            doc_id,
            min((i for i in ids[squeezed(text)] if i is not None), default=None),
            len(ids[squeezed(text)]),
            hashlib.sha256(squeezed(text).encode()).hexdigest(),
        )
        for doc_id, text, *_ in rows
    )
    # Small blocks: several rounds of pairs.
    got = exact_dedup.find_exact(docs, block_bytes=16).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = [r for r in got if r.kept]
    assert len(kept) == len(ids) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_stage(spark, docs, rows):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [squeezed(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({squeezed(r[1]) for r in rows})


def test_near(spark, docs, rows):
    found = near_components([r[1] for r in rows], 85, 3)
    least = {}
    for (size, root), row in zip(found, rows):
        least.setdefault(root, []).append(row[0])
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in least.items()}
    expected = Counter((row[0], size, least[root]) for (size, root), row in zip(found, rows))
    got = minhash.find_near(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_stage(spark, docs, rows):
    kept = minhash.keep_one(docs, percent=80, words=5)
    assert kept.columns == docs.columns
    assert kept.count() == len({root for _, root in near_components([r[1] for r in rows], 80, 5)})


@pytest.fixture
def cut_anew(spark):
    """Scans as one partition at first; calling the fixture cuts later ones differently."""
    name = "spark.sql.files.minPartitionNum"
    spark.conf.set(name, "1")
    yield lambda: spark.conf.set(name, "64")
    spark.conf.unset(name)


def test_near_when_scans_are_cut_anew(spark, tmp_path, cut_anew, monkeypatch):
    texts = [" ".join(f"w{i // 2}x{k}" for k in range(99 + i % 2)) for i in range(60)]
    docs = table(spark, tmp_path / "d.parquet", [(i, t, *[None] * 8) for i, t in enumerate(texts)])
    sets = minhash.sets
    monkeypatch.setattr(minhash, "sets", lambda *given: cut_anew() or sets(*given))
    got = {r.doc_id: r.component_id for r in minhash.find_near(docs).collect()}
    assert got == {i: i - i % 2 for i in range(60)}


@pytest.mark.parametrize("stage", [exact_dedup.keep_first, minhash.keep_one, weak_rules.keep_good])
def test_stages_when_scans_are_cut_anew(spark, docs, cut_anew, stage):
    expected = Counter(tuple(r) for r in stage(docs).collect())
    kept = stage(docs)
    cut_anew()
    assert Counter(tuple(r) for r in kept.collect()) == expected


def test_large_group_of_near_copies(spark, tmp_path):
    """A chain of edits: links through leaders and the complete comparison find all of it."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(300):
        words = list(words)
        for at in rng.integers(0, 200, 3):
            words[at] = f"x{rng.integers(1 << 40)}"
        texts.append(" ".join(words))
    rows = [(i, t, *[None] * 8) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in minhash.find_near(table(spark, tmp_path / "d.parquet", rows)).collect()}
    assert got == {i: root for i, (_, root) in enumerate(near_components(texts, 85, 3))}


def test_bands_follow_the_threshold(spark, tmp_path):
    assert minhash.band_count(85) == 9
    for percent in (50, 80, 85, 90):
        assert 2 * (1 - (percent / 100) ** minhash.ROWS) ** minhash.band_count(percent) <= 4e-4
    # 89 of 111 shingles in common, and no table of nine bands where they meet.
    words = [f"382y{i}" for i in range(115)]
    docs = table(spark, tmp_path / "d.parquet", [(i, " ".join(words[11 * i :][:104]), *[None] * 8) for i in range(2)])
    assert minhash.keep_one(docs, percent=80, words=5).count() == 1


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(1, 1 << 62, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.92], rng.integers(1, 1 << 62, 5).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        side = [
            {"size": np.array([len(x)]), "sketch": np.frombuffer(minhash.sketch(x), np.uint8)[None]} for x in (a, b)
        ]
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert minhash._possible(*side, 85).all()


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 90, (60, 2))] + [(i, i + 1) for i in range(100, 140)]
    links += [(500, i) for i in range(501, 560)]
    root = {n: n for link in links for n in link if link[0] != link[1]}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {n: find(n) for n in root} and len(got) == len(root)


def test_empty_tables(spark, tmp_path):
    none = table(spark, tmp_path / "none.parquet", [])
    assert exact_dedup.find_exact(none).count() == 0
    assert minhash.find_near(none).count() == 0
    assert minhash.keep_one(none).columns == none.columns


def test_rounds_end_when_all_buckets_are_inside_one_component(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:100] + [f"x{k}"]) for k in range(12)] + [" ".join(f"{k}_{i}" for i in range(60)) for k in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    calls, plain = [], minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda *a: calls.append(1) or plain(*a))
    got = {r.doc_id: r.component_id for r in minhash.find_near(docs).collect()}
    assert got == {k: 0 if k < 12 else k for k in range(20)}
    assert len(calls) == 1


def test_links_that_join_components(spark):
    links = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    first, second = [(1, 2), (5, 9), (9, 7), (20, 21)], [(2, 7), (30, 31), (21, 40), (1, 2), (9, 5)]
    known = components.components(links(first))
    got = sorted(map(tuple, minhash._joined(known, links(second)).collect()))
    assert got == sorted(map(tuple, components.components(links(first + second)).collect()))
