"""The hierarchy in rounds against one that merges split by split."""

import random
from collections import defaultdict

import pytest

from toolgauge.operators import hierarchy, ranking


def stepwise(leaves, splits, points):
    """{(leaf, t): points with the same number share a cluster}, None for noise."""
    top = {leaf: leaf for leaf in leaves}
    state = {leaf: [0, 0.0, 0.0] for leaf in leaves}  # rows below, their best value, density at birth
    waiting = defaultdict(list)
    for leaf, t, weight in points:
        waiting[leaf].append((t, weight, leaf))
    parent, chosen, place, own = {}, {}, {}, {leaf: leaf for leaf in leaves}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for step, (a, b, w, u, v) in enumerate(sorted(splits, key=lambda s: s[2:])):
        new, below, inner, later = ("n", step), 0, 0.0, []
        roots = [find(a), find(b)]
        for root in roots:
            node = own[root]
            rows, best, born = state[node]
            inside = [p for p in waiting[node] if p[0] < w]
            later += [p for p in waiting.pop(node) if p[0] >= w] if node in waiting else []
            for t, _, leaf in inside:
                place[leaf, t] = node
            total = rows + sum(p[1] for p in inside)
            stability = sum(p[1] / max(p[0], 1e-150) for p in inside) + rows * born - total / max(w, 1e-150)
            chosen[node] = best <= stability * (1 + 1e-9)
            parent[node] = new
            below, inner = below + total, inner + max(best, stability)
        top[roots[0]] = roots[1]
        own[roots[1]] = new
        state[new] = [below, inner, 1 / max(w, 1e-150)]
        waiting[new] = later
    out = {}
    for leaf, t, _ in points:
        node, label = place.get((leaf, t)), None
        while node in chosen:
            label = node if chosen[node] else label
            node = parent.get(node)
        out[leaf, t] = label
    return out


def tree(shape, n, rng):
    """(a, b, w, u, v) over leaves 0..n; weights differ unless the shape says so."""
    weights = rng.sample(range(1, 10 * n), n)
    if shape == "star":
        ends = [(0, i) for i in range(1, n + 1)]
    elif shape in ("chain", "rising chain", "zigzag"):
        ends = [(i, i + 1) for i in range(n)]
        weights = sorted(weights) if shape == "rising chain" else weights
        if shape == "zigzag":
            weights = [w // 2 + (n * 10 if i % 2 else 0) for i, w in enumerate(weights)]
    elif shape == "caterpillar":
        ends = [(i, i + 1) if i % 2 == 0 else (i - 1, i + 1) for i in range(n)]
    else:
        ends = [(rng.randrange(i), i) for i in range(1, n + 1)]
        if shape == "ties":
            weights = [1 + w % 3 for w in weights]
    return [(a, b, w / 10, a, b) for (a, b), w in zip(ends, weights)]


def solved(spark, leaves, splits, points, monkeypatch):
    rounds = []
    merge = hierarchy._Rounds.merge
    monkeypatch.setattr(hierarchy._Rounds, "merge", lambda self: (rounds.append(1), merge(self))[1])
    rows = [(i, weight, t, leaf) for i, (leaf, t, weight) in enumerate(points)]
    found = hierarchy.select_clusters(
        hierarchy.Leaves(
            spark.createDataFrame(rows, "pid long, weight long, t double, leaf long"),
            spark.createDataFrame(splits, "a long, b long, w double, u long, v long"),
        )
    ).collect()
    assert len(found) == len(rows)
    return {(rows[r["pid"]][3], rows[r["pid"]][2]): r["cluster"] for r in found}, len(rounds)


def same(found, want):
    assert found.keys() == want.keys()
    names = {}
    for key, label in want.items():
        assert names.setdefault(label, found[key]) == found[key]
        assert (label is None) == (found[key] is None)
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize(
    "shape, n", [("random", 60), ("ties", 40), ("star", 10_000), ("chain", 10_000), ("rising chain", 10_000), ("zigzag", 300), ("caterpillar", 2_000)]
)
def test_rounds_equal_steps(spark, monkeypatch, shape, n):
    rng = random.Random(shape)
    splits = tree(shape, n, rng)
    points = {}
    for leaf in range(n + 1):
        for _ in range(rng.randint(1, 3)):
            # Some at distance zero, some that join long after the leaf has merged.
            t = rng.choice([0.0, rng.random() * 0.1, rng.random() * n, rng.random() * n / 10])
            points[leaf, t] = rng.randint(1, 9)
        points[leaf, 0.05] = 5
    points = [(leaf, t, weight) for (leaf, t), weight in points.items()]
    found, rounds = solved(spark, range(n + 1), splits, points, monkeypatch)
    same(found, stepwise(range(n + 1), splits, points))
    assert rounds <= 12


def test_running_aggregates_over_many_pieces(spark, monkeypatch):
    """A group that holds nearly all rows is spread over pieces, and no task sees it whole."""
    rng = random.Random(5)
    rows = [("hot" if i % 50 else f"g{i % 7}", i, rng.randint(-9, 9)) for i in range(6000)]
    frame = spark.createDataFrame(rows, "g string, i long, x long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pieces = ranking.in_pieces(frame, ["g", "i"])
        largest = max(r["count"] for r in pieces.groupBy("g", "_piece").count().collect())
        found = ranking.running(pieces, ["g"], ["i"], {"s": pieces["x"]}, {"m": pieces["x"]}).collect()
        before = ranking.running(pieces, ["g"], ["i"], {"s": pieces["x"]}, {"m": pieces["x"]}, until=-1).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest <= 6000 / 8 * 2
    total, high = defaultdict(int), {}
    after = {(r["g"], r["i"]): (r["s"], r["m"]) for r in found}
    until = {(r["g"], r["i"]): (r["s"], r["m"]) for r in before}
    for g, i, x in rows:
        assert until[g, i] == (total[g], high.get(g))
        total[g] += x
        high[g] = max(high.get(g, x), x)
        assert after[g, i] == (total[g], high[g])
