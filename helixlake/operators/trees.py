"""Trees as rows: root distances, midpoint roots and true tip distances by ancestor doubling.

A node is a row (tree_id, node, parent, length, label); the root has no parent. Whoever is 2^k steps above a node is who is
2^(k-1) steps above that one, so a tree of any shape takes log2(depth) self-joins, and no tree is walked whole in one task. Lengths
are not negative. Nodes whose parent isn't there are roots; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import stored
from .joins import looked_up

_KEY = ["tree_id", "node"]


def _far_of_root() -> Column:
    return F.lit(0.0).alias("far")


def ladder(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(tree_id, node, up, far) by distance 1, 2, 4, ... for nodes that have such an ancestor, and (tree_id, node, far) to the root."""
    known = nodes.select("tree_id", F.col("node").alias("parent"))
    linked = nodes.join(known, ["tree_id", "parent"], "left_semi").select(*_KEY, F.col("parent").alias("up"), F.col("length").cast("double").alias("far"))
    reached = stored(nodes.select(*_KEY).join(linked.select(*_KEY), _KEY, "left_anti").select(*_KEY, _far_of_root()), "tree-roots")
    state, rungs = stored(linked, "tree-rung"), []
    while state.limit(1).count():
        rungs.append(state)
        # A node's ancestor has an ancestor as far up again, or is itself at the root by now.
        ahead = state.select("tree_id", F.col("node").alias("up"), F.col("up").alias("next"), F.col("far").alias("more"))
        done = reached.select("tree_id", F.col("node").alias("up"), F.lit(None).cast("int").alias("next"), F.col("far").alias("more"))
        further = stored(looked_up(state, ahead.unionByName(done), ["tree_id", "up"]).select(*_KEY, F.col("next").alias("up"), (F.col("far") + F.col("more")).alias("far")), "tree-step")
        reached = reached.unionByName(further.where("up is null").select(*_KEY, "far"))
        state = further.where("up is not null")
    return rungs, stored(reached, "tree-far")


def ancestors(start: DataFrame, rungs: list[DataFrame]) -> DataFrame:
    """(tree_id, start) -> tree_id, start, node, away: every start with itself and all that stand above it."""
    seen = start.select("tree_id", "start", F.col("start").alias("node"), F.lit(0.0).alias("away"))
    for rung in rungs:
        above = looked_up(stored(seen, "tree-seen"), rung, _KEY)
        seen = seen.unionByName(above.select("tree_id", "start", F.col("up").alias("node"), (F.col("away") + F.col("far")).alias("away")))
    return stored(seen, "tree-ancestors")


def tips(nodes: DataFrame) -> DataFrame:
    """Labelled nodes without children."""
    parents = nodes.select("tree_id", F.col("parent").alias("node")).where("node is not null").distinct()
    return nodes.where("label is not null and label <> ''").join(parents, _KEY, "left_anti").select(*_KEY, "label")


def distances_from(start: DataFrame, far: DataFrame, rungs: list[DataFrame]) -> DataFrame:
    """(tree_id, start: one node a tree) -> tree_id, node, away: the path's length from the start to every node of its tree.

    The start's own ancestors are marked; the lowest common ancestor of the start and a node is the first marked one on the
    node's way up, which is found from the longest jumps to the shortest: a jump is taken if it leads to no marked node.
    """
    marked = ancestors(start, rungs).select("tree_id", "node", F.lit(True).alias("marked"))
    place = stored(far.select("tree_id", "node", F.col("node").alias("at")), "tree-place")
    first = place.join(marked, _KEY, "left_semi")
    rest = stored(place.join(marked, _KEY, "left_anti"), "tree-unmarked")
    for rung in reversed(rungs):
        hop = rung.select("tree_id", F.col("node").alias("at"), "up").join(marked.select("tree_id", F.col("node").alias("up")), ["tree_id", "up"], "left_anti")
        moved = looked_up(rest, hop, ["tree_id", "at"]).select(*_KEY, F.col("up").alias("at"))
        rest = stored(moved.unionByName(rest.join(hop, ["tree_id", "at"], "left_anti").select(*_KEY, "at")), "tree-hop")
    if rungs:
        parent = rungs[0].select("tree_id", F.col("node").alias("at"), "up")
        first = first.unionByName(looked_up(rest, parent, ["tree_id", "at"]).select(*_KEY, F.col("up").alias("at")))
    met = stored(first, "tree-met")
    of = far.select("tree_id", F.col("node").alias("at"), F.col("far").alias("at_far"))
    begun = start.join(far.withColumnRenamed("node", "start"), ["tree_id", "start"]).select("tree_id", F.col("far").alias("start_far"))  # a row a tree
    rows = looked_up(met, of, ["tree_id", "at"]).join(far, _KEY)
    return looked_up(stored(rows, "tree-away"), begun, ["tree_id"]).select(*_KEY, (F.col("far") + F.col("start_far") - 2 * F.col("at_far")).alias("away"))


def root_distances(nodes: DataFrame) -> DataFrame:
    """(tree_id, node, parent, length, label, rooted) -> tree_id, tip, root_distance.

    A tree that isn't rooted gets its root on the middle of the longest path between tips: the tip farthest from anywhere (a) is
    one end of it, the tip farthest from that one (b) the other, and a tip is as far from the middle as it is from the farther end, less half the
    path. Ties go to the least label. Trees of one tip stay as they are.
    """
    nodes = stored(nodes, "tree-nodes")
    rungs, far = ladder(nodes)
    ends = stored(tips(nodes).join(far, _KEY), "tree-tips")
    loose = nodes.where("parent is null and not rooted").select("tree_id").distinct()
    furthest = lambda rows, by: rows.groupBy("tree_id").agg(F.min(F.struct((-F.col(by)).alias("d"), "label", "node")).alias("m")).select("tree_id", F.col("m.node").alias("start"), (-F.col("m.d")).alias("most"))
    apart = ends.join(loose, "tree_id", "left_semi")
    a = stored(furthest(apart, "far"), "tree-end")
    from_a = stored(distances_from(a, far, rungs).join(ends.select(*_KEY, "label"), _KEY), "tree-from")
    b = stored(furthest(from_a, "away"), "tree-end")
    from_b = distances_from(b, far, rungs).select(*_KEY, F.col("away").alias("back"))
    # b has one row a tree, a tree any share of the rows.
    middle = looked_up(stored(from_a.join(from_b, _KEY), "tree-both"), b.select("tree_id", "most"), ["tree_id"])
    middle = middle.select("tree_id", "node", (F.greatest("away", "back") - F.col("most") / 2).alias("root_distance"))
    out = ends.join(middle, _KEY, "left").join(ends.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tree_id", F.lit(True).alias("many")), "tree_id", "left")
    return out.select("tree_id", F.col("label").alias("tip"), F.when(F.col("many"), F.coalesce("root_distance", "far")).otherwise(F.col("far")).alias("root_distance"))


def nearest_tips(nodes: DataFrame, samples: DataFrame, k: int = 10) -> DataFrame:
    """nodes and samples (tree_id, label) -> tree_id, sample, place, tip, distance: the k other tips nearest by path length.

    Every node keeps the k + 1 tips nearest below it, gathered by doubling; a sample looks at those of its ancestors. A tip is
    found at the lowest common ancestor, at its true distance, unless k others are as near; higher up it only seems farther.
    Ties go to the least label. So no pairs of all tips are made: a node passes on k + 1 rows a round.
    """
    nodes = stored(nodes, "tree-nodes")
    rungs, _ = ladder(nodes)
    ends = stored(tips(nodes), "tree-tips")
    best = lambda rows: rows.withColumn("_r", F.row_number().over(W.partitionBy(*_KEY).orderBy("away", "tip"))).where(F.col("_r") <= k + 1).drop("_r")
    below = stored(ends.select(*_KEY, F.col("label").alias("tip"), F.lit(0.0).alias("away")), "tree-below")
    for rung in rungs:
        given = below.join(rung, _KEY).select("tree_id", F.col("up").alias("node"), "tip", (F.col("away") + F.col("far")).alias("away"))
        below = stored(best(below.unionByName(given)), "tree-below")
    lists = below.groupBy(*_KEY).agg(F.collect_list(F.struct("tip", "away")).alias("near"))  # k + 1 at most
    own = ends.join(samples.select("tree_id", "label").distinct(), ["tree_id", "label"], "left_semi")
    above = ancestors(own.select("tree_id", F.col("node").alias("start")), rungs).withColumnRenamed("away", "up_to")
    met = looked_up(above, lists, _KEY).select("tree_id", "start", "up_to", F.explode("near").alias("n"))
    met = met.groupBy("tree_id", "start", F.col("n.tip").alias("tip")).agg(F.min(F.col("up_to") + F.col("n.away")).alias("distance"))
    named = met.join(ends.select("tree_id", F.col("node").alias("start"), F.col("label").alias("sample")), ["tree_id", "start"]).where("tip <> sample")
    place = F.row_number().over(W.partitionBy("tree_id", "start").orderBy("distance", "tip"))
    return named.withColumn("place", place).where(F.col("place") <= k).select("tree_id", "sample", "place", "tip", "distance")
