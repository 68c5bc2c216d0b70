"""Awkward document tables, and restatements of results in plain Python."""

import collections
import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " kept boolean, score double, component_id long, `_place` string, length long"
)


def awkward(seed=1, size=120):
    """Rows with nulls in any column, empty and long texts, ties, repeats, clashing names."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    bases = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 90, 200]))) for _ in range(25)]
    bases += ["", " ", "\n", "Same Words", "same words", "same  words", "same\twords\n", "word " * 300]
    bases += ["<|endoftext|> a<|endoftext|>b", "x" * 3000, "long text " * 4000, "\x1c \x85 \xa0 end"]
    bases += [bases[20].replace(words[0], words[1]), bases[21] + " tail", bases[22] + "!"]
    rows = []
    for i in range(size):
        text = rng.choice([*bases, None])
        doc_id = None if rng.random() < 0.05 else i
        rows.append((doc_id, text, rng.choice(["en", None]), None, None, None, 0.1, 3, "p", 7))
    rows += rows[:6]  # rows that repeat as a whole
    rows.append((rows[10][0], "another text under a doc_id that is taken", None, None, 1, True, None, None, None, None))
    return rows


def table(spark, path, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)
    frame.coalesce(1).repartition(parts).write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def near_components(texts, percent, k):
    """For each place in a list of texts: (set size, smallest place reachable), by all pairs."""
    sets = []
    for text in texts:
        w = words_of(text)
        whole = [tuple(w)] if w else []
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset(whole))
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def count(rows):
    return collections.Counter(rows)
