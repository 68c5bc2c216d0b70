"""Quality rules, classifiers and the language model."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from check_oracle import compare, connect
from llm_cases import awkward, table, words_of
from pyspark.sql import functions as F

from toolgauge.llm import ftrl, lattice, quality_model, queries, rows, sql, toxicity, weak_rules

SF_DIR = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def data():
    return awkward(5, 80)


@pytest.fixture(scope="module")
def docs(spark, data, tmp_path_factory):
    return table(spark, tmp_path_factory.mktemp("docs") / "documents.parquet", data)


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name, queries.QUERIES[name], sql.SQL[name]) == ""


def test_rule_counts(spark, docs, data):
    got = weak_rules.judge(rows.texts(docs)).collect()
    expected = Counter()
    for doc_id, text, *_ in data:
        text = text or ""
        w = [x.decode() for x in words_of_cased(text)]
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if words_of(line)]
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected[doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    assert expected == Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    )
    assert all(not (r.base_failed and r.kept) for r in got)
    assert weak_rules.keep_good(docs).columns == docs.columns


def words_of_cased(text):
    return text.encode().split()


def test_rules_find_labelled_junk(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = weak_rules.judge(rows.texts(docs)).filter("NOT base_failed").join(labels, "doc_id")
    share = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.95 and share[0] < 0.1


def test_em_weighs_rules(spark):
    """Two rules that agree outvote the pattern of a third that fires at random."""
    k = len(weak_rules.RULES)
    code = lambda *bad: sum((0 if i in bad else 2) * 3**i for i in range(k))
    patterns = [(code(), 8000), (code(0, 1, 2), 900), (code(0, 1), 300), (code(5), 160)]
    got = {r.pattern: r.posterior for r in weak_rules.posteriors(spark.createDataFrame(patterns, "pattern int, n long")).collect()}
    assert got[code()] > 0.9 and got[code(0, 1, 2)] < 0.1 and got[code(0, 1)] < 0.2


def _em(patterns):
    """The latent class model, restated with plain loops: pattern -> posterior, per rule P(bad vote | good)."""
    k, smooth = len(weak_rules.RULES), weak_rules.SMOOTHING
    votes = {p: [p // 3**i % 3 for i in range(k)] for p, _ in patterns}
    belief = weak_rules.BELIEF_SHARE * sum(n for _, n in patterns)
    alarm = weak_rules.BELIEVED_ALARM
    q = {p: 0.1 if 0 in votes[p] else 0.9 for p, _ in patterns}
    for _ in range(weak_rules.ROUNDS):
        good, bad = sum(n * q[p] for p, n in patterns), sum(n * (1 - q[p]) for p, n in patterns)
        g = [[(sum(n * q[p] for p, n in patterns if votes[p][i] == v) + smooth
               + belief * (alarm if v == 0 else (1 - alarm) / 2)) / (good + 3 * smooth + belief)
              for v in range(3)] for i in range(k)]
        b = [[(sum(n * (1 - q[p]) for p, n in patterns if votes[p][i] == v) + smooth) / (bad + 3 * smooth)
              for v in range(3)] for i in range(k)]
        for p, _ in patterns:
            odds = np.log((good + smooth) / (bad + smooth))
            odds += sum(np.log(g[i][v] / b[i][v]) for i, v in enumerate(votes[p]))
            q[p] = 1 / (1 + np.exp(-odds))
    return q, [row[0] for row in g]


def test_em_equals_plain_loops(spark):
    """Over random patterns, and with a rule that calls a fifth of the good documents bad."""
    rng, k = np.random.default_rng(12), len(weak_rules.RULES)
    seen = Counter()
    for _ in range(4000):
        bad = rng.random() < 0.2
        hit = np.where(np.arange(k) < 5, 0.6, 0.2) if bad else np.where(np.arange(k) == 6, 0.2, 0.005)
        seen[sum((0 if rng.random() < hit[i] else 1 + int(rng.random() < 0.7)) * 3**i for i in range(k))] += 1
    patterns = sorted((int(p), n) for p, n in seen.items())
    found = weak_rules.posteriors(spark.createDataFrame(patterns, "pattern int, n long")).collect()
    expected, alarms = _em(patterns)
    assert {r.pattern for r in found} == set(expected)
    assert all(abs(r.posterior - expected[r.pattern]) < 1e-9 for r in found)
    # The rule that is wrong so often is found out: nothing holds its false alarms down.
    assert alarms[6] > 0.15 and expected[sum((0 if i == 6 else 2) * 3**i for i in range(k))] > 0.9


@pytest.mark.parametrize("model, label", [(toxicity, "toxic"), (quality_model, "quality")])
def test_held_out_accuracy(spark, model, label):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = model.score(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    right = (out.predicted == out[label]).mean()
    positive, negative = (out[out[label] == x].score.to_numpy() for x in (1, 0))
    assert right > 0.95 and (positive[:, None] > negative[None]).mean() > 0.95
    share = {"toxic": 0.7, "quality": 0.98}[label]
    assert (out[out[label] == 1].predicted == 1).mean() > share
    assert (out[out[label] == 0].predicted == 0).mean() > 0.98


def test_models_take_awkward_rows(spark, docs, data, tmp_path):
    labels = spark.createDataFrame(
        [(r[0], i % 2, None if i % 7 == 0 else (i // 2) % 2) for i, r in enumerate(data)], "doc_id long, quality int, toxic int"
    )
    for model in (toxicity, quality_model):
        got = model.score(docs, labels).collect()
        assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
        nothing = model.score(docs, labels.limit(0)).collect()
        assert {r.score for r in nothing} == {0.5}
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.count() <= len(data)
    none = table(spark, tmp_path / "none.parquet", [])
    assert toxicity.score(none, labels).count() == 0 and weak_rules.judge(rows.texts(none)).count() == 0


def test_training_takes_documents_that_are_there_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ftrl, "MAX_TRAIN", 40)
    rows_ = [(i, f"{'bad awful' if i % 2 else 'good fine'} w{i % 5} x{i % 3}", *[None] * 8) for i in range(60)]
    docs = table(spark, tmp_path / "d.parquet", rows_)
    present = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    absent = spark.range(1000, 3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    expected = toxicity.fit(docs, present)
    assert expected and toxicity.fit(docs, present.union(absent)) == expected
    assert toxicity.fit(docs.union(docs.filter("doc_id < 9")), present) == expected
    assert toxicity.keep_clean(docs, absent).count() == 60


def test_held_out_rows_teach_nothing(spark, docs):
    """Other labels for held-out rows leave all scores as they are."""
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    other = labels.withColumn("toxic", F.when(ftrl.held_out(0, 5), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit(docs, x) for x in (labels, other))
    assert one == two and one


def _plain_ftrl(rows_, settings):
    """Follow the regularised leader, one coordinate after the other."""
    z, n = Counter(), Counter()
    ones = sum(label for label, _ in rows_)
    rare = 1.0 if 2 * ones < len(rows_) else 0.0
    odds = (len(rows_) - ones) / max(ones, 1) if rare else ones / max(len(rows_) - ones, 1)

    def weight(i):
        l1, l2 = (settings.l1, settings.l2) if i else (0.0, 0.0)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((settings.beta + n[i] ** 0.5) / settings.alpha + l2)

    for _ in range(settings.epochs):
        for label, at in rows_:
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            if label == rare:
                g *= max(odds, 1) ** settings.balance
            for i in at:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / settings.alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}


@pytest.mark.parametrize("model", [toxicity, quality_model])
def test_training_equals_one_coordinate_at_a_time(model):
    rng = np.random.default_rng(4)
    rows_ = []
    for _ in range(600):
        label = float(rng.random() < 0.25)
        own = rng.integers(1, 30, 4) if label else rng.integers(20, 60, 4)
        rows_.append((label, np.unique(np.concatenate([[0], own, rng.integers(100, 400, 8)])).astype(np.int64)))
    got = ftrl.train(rows_, model.SETTINGS)
    expected = _plain_ftrl([(label, [int(i) for i in at]) for label, at in rows_], model.SETTINGS)
    assert len(expected) > 10 and got.keys() == expected.keys()
    assert all(abs(got[i] - expected[i]) < 1e-9 for i in expected)


def test_pairs_and_skips_equal_a_loop():
    """Words, neighbours and skip-grams of the toxicity model, found with plain loops."""
    grams, mask = toxicity.SETTINGS.grams, (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) & mask
        return x ^ (x >> 29)

    low = lambda x: max(mix(x) & ((1 << ftrl.BITS) - 1), 1)
    texts = ["You, YOU  fool... of a fool", "", "one", "a b a b a b c", "ä ö ü " * 9]
    expected = set()
    for i, text in enumerate(texts):
        h = [xxhash.xxh3_64_intdigest(w) for w in regex.findall(r"\w+|[^\w\s]+", text.lower())]
        found = {low(x) for x in h}
        for d in grams.pairs:
            found |= {low((mix((a + 17 * d) & mask) * 0x9E3779B97F4A7C15 + b) & mask) for a, b in zip(h, h[d:])}
        expected |= {i << ftrl.BITS | x for x in found}
    assert set(ftrl.features(texts, grams)[0].tolist()) == expected


def test_scores_equal_a_sum_of_weights(spark, docs, data):
    grams = toxicity.SETTINGS.grams
    weights = {0: -0.5, **{i: (i % 7 - 3) / 5 for i in range(1, 1 << ftrl.BITS, 3)}}
    got = Counter((r.doc_id, round(r.score, 9)) for r in ftrl.scored(rows.texts(docs), weights, grams).collect())
    expected = Counter()
    for doc_id, text, *_ in data:
        at = [int(x) for x in ftrl.features([text or ""], grams)[0]]
        expected[doc_id, round(1 / (1 + np.exp(-np.clip(weights[0] + sum(weights.get(i, 0) for i in at), -35, 35))), 9)] += 1
    assert got == expected


def test_features_do_not_depend_on_company():
    grams = quality_model.SETTINGS.grams
    texts = ["a b a b", "", "One two three !!", "x", "a b a b c"]
    together = ftrl.features(texts, grams)[0]
    mask = (1 << ftrl.BITS) - 1
    for i, text in enumerate(texts):
        alone = set((ftrl.features([text], grams)[0] & np.uint64(mask)).tolist())
        assert {int(x) & mask for x in together if int(x) >> ftrl.BITS == i} == alone


def brute_marginal(word, names, scores):
    forward = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = names.get(word[start:end])
            if piece is not None:
                forward[end] += forward[start] * math.exp(scores[piece])
    return math.log(forward[-1])


def test_lattice_is_the_sum_over_segmentations():
    vocabulary = lattice.Vocabulary(lattice.pieces(PIECES))
    scores = lattice.order_scores(len(vocabulary.names))
    words = [f" {w}".encode() for w in ("the", "a", "thouha", "ciónmente", "汉字", "x" * 40)] + [b" " + b"ab" * 45, b" \xff\xfe"]
    got = lattice.marginals(words, vocabulary, scores)
    assert np.allclose(got, [brute_marginal(w, vocabulary.names, scores) for w in words])
    counts = lattice.expected(words, vocabulary, scores)
    # Whatever the segmentation, its pieces cover the word.
    assert math.isclose(sum(len(n) * counts[i] for n, i in vocabulary.names.items()), sum(map(len, words)))


def test_language_model(spark, docs, data):
    got = lattice.score(rows.texts(docs), PIECES, em_rounds=1).collect()
    held = lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
    texts = [(r[0], [*words_of(r[1]), None]) for r in data]
    seen = Counter(w for doc_id, words in texts if not held(doc_id) for w in words)
    n, kinds = sum(seen.values()), len(seen)
    expected = Counter()
    for doc_id, words in texts:
        base = sum(math.log10((seen[w] + 1) / (n + kinds + 1)) for w in words)
        expected[doc_id, held(doc_id), len(words), sum(seen[w] > 0 for w in words), n, round(base, 6)] += 1
    assert expected == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    )
    # The score, with the pieces' scores trained once more by the brute-force recursion.
    names = lattice.pieces(PIECES)
    vocabulary = lattice.Vocabulary(names)
    trained = [w for w in seen if w is not None]
    totals = lattice.expected([b" " + w for w in trained], vocabulary, lattice.order_scores(len(names))) + lattice.SMOOTHING
    scores = np.log(totals / totals.sum())
    once, twice = (sum(seen[w] == k for w in trained) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice) if once else 0.5))

    def word(w):
        if w is None:
            return math.log10((seen[None] + 0.5) / (n + 1))
        rest = (d * len(trained) + 0.5) * math.exp(brute_marginal(b" " + w, vocabulary.names, scores))
        return math.log10((max(seen[w] - d, 0) + rest) / (n + 1))

    short = [(doc_id, words) for doc_id, words in texts if all(w is None or len(w) < 60 for w in words)]
    wanted = Counter((doc_id, round(sum(map(word, words)), 4)) for doc_id, words in short)
    assert not wanted - Counter((r.doc_id, round(r.score, 4)) for r in got)


def test_language_model_without_training(spark, tmp_path):
    doc_id = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = table(spark, tmp_path / "d.parquet", [(doc_id, "a b", *[None] * 8)])
    (row,) = lattice.score(rows.texts(docs), PIECES).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and row.score < 0
    assert lattice.score(rows.texts(table(spark, tmp_path / "n.parquet", [])), PIECES).count() == 0


def test_calibration_moves_only_the_constant():
    rng = np.random.default_rng(8)
    rows_ = []
    for _ in range(2000):
        label = float(rng.random() < 0.1)
        own = rng.integers(100, 140, 2) if label else []
        rows_.append((label, np.concatenate([[0], np.unique(np.concatenate([own, rng.integers(1000, 9000, 20)]))]).astype(np.int64)))
    settings = ftrl.Settings(ftrl.Grams(), alpha=1.0, l1=10.0, balance=0.5, calibrate=5)
    plain, moved = ftrl.train(rows_, settings), ftrl.calibrated(rows_, settings)
    assert {k: v for k, v in plain.items() if k} == {k: v for k, v in moved.items() if k}
    wrong = lambda w: sum((sum(w.get(i, 0.0) for i in at) >= 0) != label for label, at in rows_)
    assert wrong(moved) <= max(wrong(plain), 20)


def test_calibration_without_one_label():
    rows_ = [(0.0, np.array([0, 5])), (1.0, np.array([0, 6]))]
    settings = ftrl.Settings(ftrl.Grams(), calibrate=5)
    assert ftrl.calibrated(rows_, settings) == ftrl.train(rows_, settings)


def test_features_with_a_weight_are_all_a_score_needs():
    texts = ["Free MONEY now, now!", "", "a\x1cb \x85 naïve — ok", "x_1 " * 40, "über alles"]
    for settings in (toxicity.SETTINGS, quality_model.SETTINGS):
        every, counts = ftrl.features(texts, settings.grams)
        wanted = np.zeros(1 << ftrl.BITS, bool)
        wanted[(every[::3] & np.uint64((1 << ftrl.BITS) - 1)).astype(np.int64)] = True
        some, again = ftrl.features(texts, settings.grams, wanted)
        assert np.array_equal(some, every[wanted[(every & np.uint64((1 << ftrl.BITS) - 1)).astype(np.int64)]])
        assert 0 < len(some) < len(every) and np.array_equal(counts, again)
    text = "".join(map(chr, range(128))) * 2
    assert ftrl._words(text) == regex.findall(r"\w+|[^\w\s]+", text)
