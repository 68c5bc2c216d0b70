"""Exact nearest neighbours and lightest outgoing edges over chunks of vectors.

A task takes one chunk of points and reads those chunks that can hold a neighbour or an edge that
is still wanted, one after the other; what it has found so far narrows what comes next. Nothing
but results is shuffled: neighbours per point, or one edge per component and task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from toolgauge.operators import chunks, distance
from toolgauge.operators.vector_index import SLACK, Index, at_most, close_pairs, span
from toolgauge.session import settle

# Distances of the product form are this close to exact ones, relatively.
_ROUGH = 1e-7
_EXACT_AT_ONCE = 65_536
# Rounding of the product form, as a share of the squared norms.
_LOST = 1e-12
# Rows compared with a chunk at once.
_AT_ONCE = 256
# Neighbours per point among the known edges of a spanning tree: the more are known, the fewer
# points have an unknown one that could be lighter.
KNOWN = 12


def _nearest_of(x: np.ndarray, y: np.ndarray, same: np.ndarray | None, k: int):
    """(row of x, row of y, distance): the k rows of y nearest to each row of x, exactly.

    What the product form ranks close to the k-th place is measured again.
    """
    found = []
    for start in range(0, len(x), 512):
        d = distance.pairwise(x[start : start + 512], y)
        if same is not None:
            d[np.arange(len(d)), same[start : start + 512]] = np.inf
        take = min(k, d.shape[1])
        edge = np.partition(d, take - 1, axis=1)[:, take - 1 : take]
        rows, cols = np.nonzero((d <= edge * (1 + _ROUGH)) & np.isfinite(d))
        for at in range(0, len(rows), _EXACT_AT_ONCE):
            r, c = rows[at : at + _EXACT_AT_ONCE], cols[at : at + _EXACT_AT_ONCE]
            found.append(pd.DataFrame({"row": r + start, "col": c, "dist": distance.direct(x[r + start], y[c])}))
    if not found:
        return pd.DataFrame({"row": np.empty(0, np.int64), "col": np.empty(0, np.int64), "dist": np.empty(0)})
    return pd.concat(found, ignore_index=True)


def _with_bounds(index: Index) -> DataFrame:
    """Points with the neighbours that their own block holds, and the k-th distance among them."""
    k = index.k

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pid", ignore_index=True)
        x, ids, weights = distance.matrix(rows["vec"]), rows["pid"].to_numpy(), rows["weight"].to_numpy()
        pairs = _nearest_of(x, x, np.arange(len(x)), k).sort_values(["row", "dist", "col"])
        pairs = pairs[pairs.groupby("row").cumcount() < k]
        near = [[] for _ in range(len(x))]
        for row, col, dist in zip(pairs["row"], pairs["col"], pairs["dist"]):
            near[row].append({"neighbor": int(ids[col]), "dist": float(dist), "neighbor_weight": int(weights[col])})
        bound = [found[k - 1]["dist"] if len(found) >= k else np.inf for found in near]
        return rows.assign(near=near, bound=bound)[["pid", "weight", "vec", "block", "near", "bound"]]

    schema = (
        "pid bigint, weight bigint, vec array<float>, block string,"
        " near array<struct<neighbor:bigint,dist:double,neighbor_weight:bigint>>, bound double"
    )
    found = index.points.groupBy("block").applyInPandas(own, schema)
    wide = index.levels[-1].select(F.col("node").alias("block"), "wide")
    return found.join(wide, "block").withColumn("bound", F.least("bound", "wide")).drop("wide").transform(settle)


def _pairs_for_neighbors(index: Index, points: DataFrame) -> DataFrame:
    """Ordered pairs of blocks in which b may hold a neighbour of a point of a."""
    facts = points.groupBy("block").agg(F.max("bound").alias("limit"))
    near = lambda gap: at_most(gap, F.col("a_limit"))
    return close_pairs(index, facts, {"limit": F.max}, near, ordered=True).filter("a != b")


def _reached(gap: np.ndarray, limit) -> np.ndarray:
    return gap <= limit * (1 + SLACK) + SLACK


def _gaps(middle: np.ndarray, radius, middles: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Least distances between a ball and other balls; rounding of centres is left to SLACK."""
    away = distance.direct(middles, np.broadcast_to(middle, middles.shape))
    return np.maximum(away * (1 - _ROUGH) - radius - radii, 0.0)


def _blocks(chunk: dict[str, np.ndarray]) -> list[slice]:
    ends = [*chunk["starts"][1:].tolist(), len(chunk["pid"])]
    return [slice(a, b) for a, b in zip(chunk["starts"].tolist(), ends)]


def _rows_of(chunk: dict[str, np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Places of the rows in the wanted blocks."""
    sizes = np.diff(np.append(chunk["starts"], len(chunk["pid"])))
    return np.flatnonzero(np.repeat(wanted, sizes))


def _squares(x: np.ndarray, x2: np.ndarray, y: np.ndarray, y2: np.ndarray) -> np.ndarray:
    return np.maximum(x2[:, None] + y2[None, :] - 2.0 * (x @ y.T), 0.0)


def _below(limit: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
    """Squares of the product form that a distance within `limit` may show, per row."""
    # The form loses digits in proportion to the squared norms.
    return limit * limit * (1 + 4 * _ROUGH) + _LOST * (x2 + (y2.max() if len(y2) else 0.0))


def _exact(x: np.ndarray, rows: np.ndarray, y: np.ndarray, cols: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows))
    for at in range(0, len(rows), _EXACT_AT_ONCE):
        part = slice(at, at + _EXACT_AT_ONCE)
        out[part] = distance.direct(x[rows[part]], y[cols[part]])
    return out


class _Best:
    """The k nearest found so far of every row: distance, neighbour, its weight."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.dist = np.full((rows, k), np.inf)
        self.pid = np.full((rows, k), np.iinfo(np.int64).max)
        self.weight = np.zeros((rows, k), np.int64)

    def limit(self, rows) -> np.ndarray:
        return self.dist[rows, -1]

    def take(self, rows: np.ndarray, dist: np.ndarray, pid: np.ndarray, weight: np.ndarray) -> None:
        if not len(rows):
            return
        known, k = np.unique(rows), self.k
        row = np.concatenate([np.repeat(known, k), rows])
        dist = np.concatenate([self.dist[known].ravel(), dist])
        pid = np.concatenate([self.pid[known].ravel(), pid])
        weight = np.concatenate([self.weight[known].ravel(), weight])
        order = np.lexsort([pid, dist, row])
        first = np.searchsorted(row[order], known)
        pick = order[(first[:, None] + np.arange(k)).ravel()]
        self.dist[known] = dist[pick].reshape(-1, k)
        self.pid[known] = pid[pick].reshape(-1, k)
        self.weight[known] = weight[pick].reshape(-1, k)


def _offer(best: _Best, own: dict, block: slice, other: dict, cols: np.ndarray, same: bool) -> None:
    """Compare rows of a block with some rows of a chunk."""
    y, y2 = (other["vec"], other["norm"]) if len(cols) == len(other["pid"]) else (other["vec"][cols], other["norm"][cols])
    for start in range(block.start, block.stop, _AT_ONCE):
        rows = np.arange(start, min(start + _AT_ONCE, block.stop))
        x, x2 = own["vec"][rows], own["norm"][rows]
        squares = _squares(x, x2, y, y2)
        if same:
            met = np.searchsorted(cols, rows)
            inside = (met < len(cols)) & (cols[np.minimum(met, len(cols) - 1)] == rows)
            squares[np.flatnonzero(inside), met[inside]] = np.inf
        limit = _below(best.limit(rows), x2, y2)
        close = squares <= limit[:, None]
        if np.count_nonzero(close) > 4 * best.k * len(rows) and squares.shape[1] > best.k:
            # What the product form ranks close to the k-th place is measured again.
            edge = np.partition(squares, best.k - 1, axis=1)[:, best.k - 1]
            close &= squares <= _below(np.sqrt(edge), 2 * x2, 2 * y2)[:, None]
        r, c = np.nonzero(close & np.isfinite(squares))
        at = cols[c]
        best.take(rows[r], _exact(x, r, y, c), other["pid"][at], other["weight"][at])


def nearest(index: Index, k: int | None = None) -> DataFrame:
    """(pid, neighbor, dist, neighbor_weight): the k nearest other points of each point."""
    k, stored, spark = k or index.k, index.chunks, index.points.sparkSession
    folder, heads = stored.folder, stored.heads
    numbers = np.array([head["chunk"] for head in heads])

    def compare(number: int) -> pd.DataFrame:
        middles = np.array([head["middle"] for head in heads])
        radii = np.array([head["radius"] for head in heads])
        own = _normed(chunks.vectors(folder, number))
        blocks, best = _blocks(own), _Best(len(own["pid"]), k)
        me = int(np.flatnonzero(numbers == number)[0])
        # The own chunk first, then the others by how near they can be.
        gaps = _gaps(middles[me], radii[me], middles, radii)
        gaps[me] = -1.0
        for j in np.argsort(gaps, kind="stable"):
            if not _reached(gaps[j], best.dist[:, -1].max()):
                break
            other = own if j == me else _normed(chunks.vectors(folder, int(numbers[j])))
            for b, block in enumerate(blocks):
                gap = _gaps(own["middles"][b], own["radii"][b], other["middles"], other["radii"])
                cols = _rows_of(other, _reached(gap, best.limit(block).max()))
                if len(cols):
                    _offer(best, own, block, other, cols, j == me)
        row, place = np.nonzero(np.isfinite(best.dist))
        return pd.DataFrame(
            {
                "pid": own["pid"][row],
                "neighbor": best.pid[row, place],
                "dist": best.dist[row, place],
                "neighbor_weight": best.weight[row, place],
            }
        )

    return chunks.for_each(spark, stored, compare, "pid long, neighbor long, dist double, neighbor_weight long")


def _normed(chunk: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return chunk | {"norm": np.sum(chunk["vec"] * chunk["vec"], axis=1)}


def core_distances(index: Index, neighbors: DataFrame) -> DataFrame:
    """(pid, core): distance to the k-th other row, copies counted one by one."""
    nearest_first = F.array_sort(
        F.collect_list(F.struct("dist", "neighbor", "neighbor_weight"))
    )
    lists = neighbors.groupBy("pid").agg(nearest_first.alias("near"))
    missing = F.lit(index.k) - (F.col("weight") - 1)
    walked = F.aggregate(
        F.col("near"),
        F.struct(missing.cast("bigint").alias("missing"), F.lit(0.0).alias("core")),
        lambda acc, x: F.struct(
            (acc["missing"] - x["neighbor_weight"]).alias("missing"),
            F.when(acc["missing"] > 0, x["dist"]).otherwise(acc["core"]).alias("core"),
        ),
    )
    return (
        index.points.select("pid", "weight")
        .join(lists, "pid", "left")
        .select("pid", "weight", F.coalesce(walked["core"], F.lit(0.0)).alias("core"))
    )


def known_edges(index: Index, neighbors: DataFrame, cores: DataFrame) -> DataFrame:
    """(u, v, w), u < v: edges whose lengths are known already, enough to connect all points.

    `w` is the mutual reachability distance. They give every component of a round an edge that
    leaves it, hence a bound on its lightest one.
    """
    seen = neighbors.select(F.col("pid").alias("u"), F.col("neighbor").alias("v"), "dist").unionAll(index.anchors)
    own = cores.select(F.col("pid").alias("u"), F.col("core").alias("core_u"))
    other = cores.select(F.col("pid").alias("v"), F.col("core").alias("core_v"))
    return (
        seen.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .agg(F.min("dist").alias("dist"))
        .join(own, "u")
        .join(other, "v")
        .select("u", "v", F.greatest("dist", "core_u", "core_v").alias("w"))
    )


def edges_inside(index: Index, edges: DataFrame, cores: DataFrame, owners: DataFrame) -> DataFrame:
    """The known edges inside sets, and those from each point to the first of its set."""
    at = lambda end: owners.select(F.col("pid").alias(end), F.col("_set").alias(f"_set_{end}"))
    inside = edges.join(at("u"), "u").join(at("v"), "v").filter("_set_u = _set_v").select("u", "v", "w")
    points = index.points.select("pid", "vec").join(cores.select("pid", "core"), "pid").join(owners, "pid")
    first = F.min_by(F.struct("pid", "vec", "core"), "pid").alias("hub")
    hubs = points.groupBy("_set").agg(first)
    star = points.join(hubs, "_set").filter(F.col("pid") != F.col("hub.pid")).select(
        F.col("hub.pid").alias("u"),
        F.col("pid").alias("v"),
        F.greatest(span("vec", "hub.vec"), "core", "hub.core").alias("w"),
    )
    return inside.unionByName(star.join(inside.select("u", "v"), ["u", "v"], "left_anti"))


class _Lightest:
    """The lightest edge found so far out of every component of a chunk: (w, u, v), then its ends."""

    def __init__(self, part: np.ndarray, reach: np.ndarray):
        self.names, self.of = np.unique(part, return_inverse=True)
        self.limit = np.full(len(self.names), np.inf)
        np.minimum.at(self.limit, self.of, reach)
        self.found: pd.DataFrame | None = None

    def take(self, rows: np.ndarray, edges: pd.DataFrame) -> None:
        if not len(rows):
            return
        edges = edges.assign(a=self.of[rows])
        every = edges if self.found is None else pd.concat([self.found, edges])
        self.found = every.sort_values(["w", "u", "v"], kind="stable").drop_duplicates("a")
        at = self.found["a"].to_numpy()
        self.limit[at] = np.minimum(self.limit[at], self.found["w"].to_numpy())

    def edges(self) -> pd.DataFrame:
        if self.found is None:
            return pd.DataFrame({c: np.empty(0, np.float64 if c == "w" else np.int64) for c in ("a", "b", "w", "u", "v")})
        return self.found.assign(a=self.names[self.found["a"].to_numpy()])[["a", "b", "w", "u", "v"]]


def _lighter(best: _Lightest, own: dict, rows: np.ndarray, other: dict, cols: np.ndarray) -> None:
    """Edges from active rows to some rows of a chunk that are in other components."""
    y, y2 = other["vec"][cols], other["norm"][cols]
    core_y, part_y, pid_y = other["core"][cols], other["part"][cols], other["pid"][cols]
    for start in range(0, len(rows), _AT_ONCE):
        some = rows[start : start + _AT_ONCE]
        x, x2, core_x = own["vec"][some], own["norm"][some], own["core"][some]
        limit = best.limit[best.of[some]]
        close = _squares(x, x2, y, y2) <= _below(limit, x2, y2)[:, None]
        close &= core_y[None, :] <= limit[:, None]
        close &= own["part"][some][:, None] != part_y[None, :]
        r, c = np.nonzero(close)
        w = np.maximum(np.maximum(core_x[r], core_y[c]), _exact(x, r, y, c))
        # As many candidates as there are, one per component is kept.
        p, q = own["pid"][some[r]], pid_y[c]
        ok = w <= limit[r]
        best.take(some[r][ok], pd.DataFrame({"b": part_y[c], "w": w, "u": np.minimum(p, q), "v": np.maximum(p, q)})[ok])


def edge_search(index: Index, cores: DataFrame, neighbors: DataFrame) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The search of one round: lightest edges out of components, given a bound for each.

    All edges to `neighbors` are known. Any other edge of a point is as long at least as the way to
    the last of them, so only points for which that is within the bound of their component search.
    They look at points of other components whose core distances are within it, in blocks that can
    be near enough; the lightest edge of a component is found from its own end.
    """
    stored, spark = index.chunks, index.points.sparkSession
    folder, heads = stored.folder, stored.heads
    numbers = np.array([head["chunk"] for head in heads])
    last = neighbors.groupBy("pid").agg(F.max("dist").alias("beyond"), F.count("*").alias("n"))
    # Fewer neighbours than asked for are all there are.
    beyond = F.when(F.col("n") < KNOWN, float("inf")).otherwise(F.col("beyond"))
    facts = settle(
        cores.select("pid", "core").join(last, "pid", "left")
        .select("pid", "core", F.coalesce(beyond, F.lit(float("inf"))).alias("beyond"))
    )
    rounds: list[str] = []

    def search(labels: DataFrame, bounds: DataFrame) -> DataFrame:
        parts = labels.select(F.col("node").alias("pid"), F.col("up").alias("part"))
        reach = bounds.select(F.col("node").alias("part"), F.col("w").alias("reach"))
        for old in rounds:
            chunks.remove(spark, old)
        # A component without a bound is complete: it looks for nothing and lies beyond all bounds.
        named = facts.join(parts.join(reach, "part", "left"), "pid", "left").select(
            "pid", "core", "beyond", F.coalesce("part", "pid").alias("part"), F.coalesce("reach", F.lit(-1.0)).alias("reach")
        )
        at = chunks.store_facts(stored, named)
        rounds[:] = [at]

        def load(number: int) -> dict[str, np.ndarray]:
            return _normed(chunks.vectors(folder, number)) | chunks.read(at, number)

        def compare(number: int) -> pd.DataFrame:
            seen = chunks.read(at, number)
            best = _Lightest(seen["part"], seen["reach"])
            active = np.maximum(seen["core"], seen["beyond"]) <= seen["reach"]
            if not active.any():
                return best.edges()
            own = load(number)
            middles = np.array([head["middle"] for head in heads])
            radii = np.array([head["radius"] for head in heads])
            me = int(np.flatnonzero(numbers == number)[0])
            gaps = _gaps(middles[me], radii[me], middles, radii)
            gaps[me] = -1.0
            # Active rows of a block, those of one large component by themselves.
            groups = []
            for b, block in enumerate(_blocks(own)):
                rows = np.arange(block.start, block.stop)[active[block]]
                names, n = np.unique(own["part"][rows], return_counts=True)
                large = names[n > max(8, len(rows) // 4)]
                groups += [(b, rows[own["part"][rows] == name], name) for name in large]
                rest = rows[~np.isin(own["part"][rows], large)]
                if len(rest):
                    groups.append((b, rest, None))
            for j in np.argsort(gaps, kind="stable"):
                if not _reached(gaps[j], max(best.limit[best.of[rows]].max() for _, rows, _ in groups)):
                    break
                other = own if j == me else load(int(numbers[j]))
                for b, rows, name in groups:
                    limit = best.limit[best.of[rows]].max()
                    gap = _gaps(own["middles"][b], own["radii"][b], other["middles"], other["radii"])
                    cols = _rows_of(other, _reached(gap, limit))
                    cols = cols[other["core"][cols] <= limit]
                    if name is not None:
                        cols = cols[other["part"][cols] != name]
                    if len(cols):
                        _lighter(best, own, rows, other, cols)
            return best.edges()

        return chunks.for_each(spark, stored, compare, "a long, b long, w double, u long, v long")

    return search
