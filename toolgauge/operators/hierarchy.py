"""From a minimum spanning tree to flat clusters: condensed tree, excess of mass.

Campello, Moulavi, Sander 2013; McInnes, Healy 2017. A component counts as a cluster
once it holds `m` rows, where m is 5 at most. For every point the distance at which
its component gets that large depends on a handful of tree edges nearby. These times
tell tree edges apart: an edge heavier than the times of both its ends joins two
clusters (a split, seen from above), any other one only lets points join a cluster.
Without the splits the tree falls into leaf clusters, which is what remains to be
arranged in a hierarchy. Equal distances count as simultaneous.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from toolgauge.functions.stage import computed
from toolgauge.operators.forest import chain_ends, contract
from toolgauge.operators.ranking import in_pieces, running
from toolgauge.session import settle

# Stands in for distance zero, whose density is infinite.
_TINY = 1e-150
# A parent cluster wins against its children unless they are better by more than this.
_TIE = 1e-9


@dataclass(frozen=True)
class Leaves:
    points: DataFrame  # pid, weight, t, leaf
    splits: DataFrame  # a, b (leaf ids), w, u, v: a tree over the leaves


def join_times(tree: DataFrame, cores: DataFrame, m: int) -> DataFrame:
    """(pid, weight, t): distance at which the component of a point holds m rows.

    A walk from every point over its m-1 lightest steps. No walk can use more than
    the m-1 lightest edges of any point it passes, so these lists lose nothing.
    """
    ends = tree.select(F.col("u").alias("pid"), F.col("v").alias("to"), "w").unionAll(
        tree.select("v", "u", "w")
    )
    lightest = Window.partitionBy("pid").orderBy("w", "to")
    weights = cores.select(F.col("pid").alias("to"), F.col("weight").alias("to_weight"))
    steps = (
        ends.withColumn("_rank", F.row_number().over(lightest))
        .filter(F.col("_rank") < m)
        .join(weights, "to")
        .groupBy("pid")
        .agg(F.collect_list(F.struct("w", "to", "to_weight")).alias("steps"))
        .transform(settle)
    )
    walk = cores.join(steps, "pid").select(
        "pid",
        "weight",
        F.col("weight").alias("size"),
        F.col("core").alias("t"),
        F.array("pid").alias("seen"),
        "steps",
    )
    more = steps.select(F.col("pid").alias("at"), F.col("steps").alias("more"))
    for step in range(1, m):
        walk = computed(
            walk,
            pick=F.when(
                F.col("size") < m,
                F.array_min(
                    F.filter("steps", lambda s: ~F.array_contains(F.col("seen"), s["to"]))
                ),
            ),
        ).select(
            "pid",
            "weight",
            (F.col("size") + F.coalesce("pick.to_weight", F.lit(0))).alias("size"),
            F.greatest("t", "pick.w").alias("t"),
            F.array_compact(F.concat("seen", F.array("pick.to"))).alias("seen"),
            "steps",
            F.col("pick.to").alias("at"),
        )
        if step < m - 1:
            walk = walk.join(more, "at", "left").withColumn(
                "steps", F.when(F.col("more").isNull(), F.col("steps")).otherwise(F.concat("steps", "more"))
            )
        walk = walk.drop("at", "more")
    return walk.select("pid", "weight", "t")


def leaf_clusters(tree: DataFrame, cores: DataFrame, m: int) -> Leaves:
    times = join_times(tree, cores, m).transform(settle)
    at = times.select("pid", "t")
    edges = (
        tree.join(at.toDF("u", "tu"), "u").join(at.toDF("v", "tv"), "v")
    ).transform(settle)

    # Points that join at the same distance through each other move as one.
    flat = (F.col("tu") == F.col("tv")) & (F.col("w") <= F.col("tu"))
    _, groups = contract(edges.filter(flat).select("u", "v", "w"))
    grouped = (
        times.join(groups.toDF("pid", "group"), "pid", "left")
        .withColumn("group", F.coalesce("group", "pid"))
        .transform(settle)
    )
    label = grouped.select("pid", "group")
    between = (
        edges.filter(~flat)
        .join(label.toDF("u", "gu"), "u")
        .join(label.toDF("v", "gv"), "v")
        .transform(settle)
    )

    # A group that joins something older follows one of its edges; others start a leaf.
    upward = F.col("tu") > F.col("tv")
    joins = between.filter(F.col("w") <= F.greatest("tu", "tv")).select(
        F.when(upward, F.col("gu")).otherwise(F.col("gv")).alias("node"),
        F.struct(
            F.least("tu", "tv").alias("t"),
            "u",
            "v",
            F.when(upward, F.col("gv")).otherwise(F.col("gu")).alias("up"),
        ).alias("edge"),
    )
    followed = joins.groupBy("node").agg(F.min("edge").alias("edge")).transform(settle)
    starts = label.select(F.col("group").alias("node")).distinct()
    pointers = starts.join(followed, "node", "left").select(
        "node", F.coalesce("edge.up", "node").alias("up")
    )
    leaf = chain_ends(pointers).toDF("group", "leaf")

    splits = (
        between.join(followed.select("edge.u", "edge.v"), ["u", "v"], "left_anti")
        .join(leaf.toDF("gu", "a"), "gu")
        .join(leaf.toDF("gv", "b"), "gv")
        .select("a", "b", "w", "u", "v")
    )
    points = grouped.join(leaf, "group").select("pid", "weight", "t", "leaf")
    return Leaves(points.transform(settle), splits.transform(settle))


def select_clusters(leaves: Leaves) -> DataFrame:
    """(pid, cluster): the selected cluster of each point, NULL for noise.

    Cluster names are arbitrary but the same for all points of a cluster. The whole
    set is never selected, so without any split all points are noise.
    """
    points = leaves.points
    rounds = _Rounds(
        live=settle(
            leaves.splits.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "w", "u", "v")
        ),
        waiting=settle(
            points.groupBy("leaf", "t")
            .agg(F.sum("weight").alias("weight"))
            .withColumn("node", F.col("leaf").cast("string"))
        ),
        clusters=points.select(F.col("leaf").cast("string").alias("node"))
        .distinct()
        .select(
            "node", F.lit(0).cast("bigint").alias("below"), F.lit(0.0).alias("inner"), F.lit(0.0).alias("born")
        )
        .transform(settle),
    )
    while not rounds.live.isEmpty():
        rounds.merge()
    if not rounds.nodes:
        return points.select("pid", F.lit(None).cast("string").alias("cluster"))
    labels = _topmost(_all(rounds.nodes).transform(settle))
    return (
        points.join(_all(rounds.placed), ["leaf", "t"], "left")
        .join(labels, "node", "left")
        .select("pid", "cluster")
    )


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def _density(distance) -> Column:
    return F.lit(1.0) / F.greatest(distance, F.lit(_TINY))


def _name() -> Column:
    return F.concat_ws("_", F.col("u").cast("string"), F.col("v").cast("string"))


class _Rounds:
    """The hierarchy of leaf clusters, from its leaves up, in rounds of contraction.

    Every cluster first merges along its lightest split. So the splits that are the
    lightest of one of their ends fall into trees, in each of which clusters join one
    growing core, one after the other by weight. What else is known about a tree is the
    lightest split that leaves it without being anyone's lightest: up to that weight the
    core grows undisturbed, which is one round for any number of clusters. The
    grown cores go on as clusters of the next round; at least every second one of those
    with a split to another core merges then, so rounds grow with the logarithm of their number,
    on a star as on a chain.

    Along a growing core, totals are running sums, and the value of the best selection is

        V(i) = max(stability(i), V(i-1) + v(i)) = P(i) + max(0, max over j <= i of stability(j) - P(j)),

    v(i) being the value of what joins and P its running sum: nothing walks the
    hierarchy node by node, and no table but the rounds' own is as long as a chain.
    """

    def __init__(self, live: DataFrame, waiting: DataFrame, clusters: DataFrame):
        self.live = live  # a, b (clusters), w, u, v
        self.waiting = waiting  # leaf, t, weight, node: points that join this cluster or a later one
        self.clusters = clusters  # node, below (rows of its children), inner (their value), born (density)
        self.nodes: list[DataFrame] = []  # node, parent, chosen
        self.placed: list[DataFrame] = []  # leaf, t, node

    def merge(self) -> None:
        joins = self._joins().transform(settle)
        looked = (
            self.waiting.join(joins.select("node", "core", F.col("w").alias("death")), "node", "left")
            .withColumn("inside", F.coalesce(F.col("t") < F.col("death"), F.lit(False)))
            .transform(settle)
        )
        final = self._finished(joins, looked).transform(settle)
        events = self._events(final, looked)
        merges = events.filter("kind = 0")
        core = self._core(merges, events.filter("kind = 1")).transform(settle)
        grown = core.filter(F.col("death").isNotNull())
        tips = core.filter(F.col("death").isNull()).select(
            "core", F.col("node").alias("tip"), "below", "inner", F.col("lam").alias("born")
        )
        parent = F.col("parent")
        self.nodes.append(final.select("node", _name().alias("parent"), "chosen"))
        self.nodes.append(
            grown.select("node", parent, (F.col("inner") <= F.col("stability") * (1 + _TIE)).alias("chosen"))
        )
        self.placed.append(looked.filter("inside").select("leaf", "t", "node"))
        at = events.filter("kind = 1").select("core", "leaf", F.col("at").alias("t"), "weight", "i")
        reached = at.join(core.select("core", "i", "node", "death"), ["core", "i"]).transform(settle)
        self.placed.append(reached.filter(F.col("death").isNotNull()).select("leaf", "t", "node"))
        self.waiting = (
            looked.filter(F.col("death").isNull())
            .select("leaf", "t", "weight", "node")
            .unionByName(reached.filter(F.col("death").isNull()).select("leaf", "t", "weight", "node"))
            .transform(settle)
        )
        self.clusters = (
            self.clusters.join(joins, "node", "left_anti")
            .unionByName(tips.select(F.col("tip").alias("node"), "below", "inner", "born"))
            .transform(settle)
        )
        moved = joins.join(tips.select("core", "tip"), "core").select("node", "tip")
        self.live = (
            self.live.join(joins.select("u", "v"), ["u", "v"], "left_anti")
            .join(moved.toDF("a", "ta"), "a", "left")
            .join(moved.toDF("b", "tb"), "b", "left")
            .select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"), "w", "u", "v")
            .transform(settle)
        )

    def _joins(self) -> DataFrame:
        """(node, core, w, u, v): clusters that join a core in this round, and by which split."""
        pick = F.struct("w", "u", "v", "a", "b").alias("p")
        picks = (
            self.live.select(F.col("a").alias("node"), pick)
            .unionAll(self.live.select("b", pick))
            .groupBy("node")
            .agg(F.min("p").alias("p"))
            .select("node", "p.*")
            .transform(settle)
        )
        other = F.when(F.col("node") == F.col("a"), F.col("b")).otherwise(F.col("a"))
        # The split that both its ends pick is the lightest of its tree; the smaller end is the root.
        both = picks.groupBy("u", "v").agg(F.count("*").alias("n"))
        pointers = picks.join(both, ["u", "v"]).select(
            "node",
            F.when((F.col("n") == 2) & (F.col("node") < other), F.col("node")).otherwise(other).alias("up"),
        )
        core = chain_ends(pointers).toDF("node", "core")
        weight = F.struct("w", "u", "v")
        leaving = self.live.join(picks.select("u", "v"), ["u", "v"], "left_anti").select(
            F.explode(F.array("a", "b")).alias("node"), weight.alias("first")
        )
        first = leaving.join(core, "node").groupBy("core").agg(F.min("first").alias("first"))
        return (
            picks.join(core, "node")
            .join(first, "core", "left")
            .filter(F.col("first").isNull() | (weight < F.col("first")))
            .select("node", "core", "w", "u", "v")
        )

    def _finished(self, joins: DataFrame, looked: DataFrame) -> DataFrame:
        """Totals, value and choice of clusters that end by joining a core."""
        mass = looked.filter("inside").groupBy("node").agg(
            F.sum("weight").alias("n"), F.sum(F.col("weight") * _density(F.col("t"))).alias("s")
        )
        stability = F.coalesce("s", F.lit(0.0)) + F.col("below") * F.col("born") - F.col("total") * _density(F.col("w"))
        return (
            joins.join(self.clusters, "node")
            .join(mass, "node", "left")
            .withColumn("total", F.col("below") + F.coalesce("n", F.lit(0)))
            .withColumn("stability", stability)
            .withColumn("chosen", F.col("inner") <= F.col("stability") * (1 + _TIE))
            .withColumn("value", F.greatest("stability", "inner"))
            .select("node", "core", "w", "u", "v", "total", "value", "chosen")
        )

    @staticmethod
    def _events(final: DataFrame, looked: DataFrame) -> DataFrame:
        """What happens along each core by distance: merges (kind 0), then points that join (1).

        `i` merges have happened by then, with `below` rows and children worth `worth` in all.
        """
        merges = final.groupBy("core", F.col("w").alias("at"), "u", "v").agg(
            F.sum("total").alias("weight"), F.sum("value").alias("value")
        )
        joining = looked.filter(F.col("death").isNotNull() & ~F.col("inside"))
        events = merges.withColumn("kind", F.lit(0)).unionByName(
            joining.select("core", F.col("t").alias("at"), "weight", "leaf", F.lit(1).alias("kind")),
            allowMissingColumns=True,
        )
        order = ["core", "at", "kind", "u", "v", "leaf"]
        return running(
            in_pieces(events, order),
            ["core"],
            order[1:],
            sums={
                "below": F.col("weight"),
                "worth": F.coalesce("value", F.lit(0.0)),
                "i": F.when(F.col("kind") == 0, 1).otherwise(0),
            },
        ).transform(settle)

    @staticmethod
    def _core(merges: DataFrame, joining: DataFrame) -> DataFrame:
        """One row per state of a core: after merge `i` until `death`, which a tip has yet to meet."""
        mass = joining.groupBy("core", "i").agg(
            F.sum("weight").alias("n"), F.sum(F.col("weight") * _density(F.col("at"))).alias("s")
        )
        after = merges.select("core", (F.col("i") - 1).alias("i"), F.col("at").alias("death"), _name().alias("parent"))
        total = F.col("below") + F.coalesce("n", F.lit(0))
        states = (
            merges.select("core", "i", "_piece", "at", "below", "worth", _name().alias("node"))
            .join(after, ["core", "i"], "left")
            .join(mass, ["core", "i"], "left")
            .withColumn("lam", _density(F.col("at")))
            .withColumn(
                "stability",
                F.when(
                    F.col("death").isNotNull(),
                    F.coalesce("s", F.lit(0.0)) + F.col("below") * F.col("lam") - total * _density(F.col("death")),
                ),
            )
        )
        gain = {"gain": F.col("stability") - F.col("worth")}
        best = running(states, ["core"], ["i"], highest=gain, until=-1)
        return best.withColumn("inner", F.col("worth") + F.greatest("gain", F.lit(0.0)))


def _topmost(nodes: DataFrame) -> DataFrame:
    """(node, cluster): the highest chosen node at or above each node, by doubling."""
    found = nodes.select(
        "node",
        F.col("parent").alias("up"),
        F.when(F.col("chosen"), F.col("node")).alias("cluster"),
    )
    while True:
        upper = found.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("cluster").alias("c2"))
        found = (
            found.join(upper, "up", "left")
            .select("node", F.col("up2").alias("up"), F.coalesce("c2", "cluster").alias("cluster"))
            .transform(settle)
        )
        if found.filter(F.col("up").isNotNull()).isEmpty():
            return found.select("node", "cluster")
