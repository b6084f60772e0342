"""Connected components of link tables, and links among documents that share bucket keys without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, saved


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in links (a, b); any orderable type, nulls ignored.

    Each round points every node at its least neighbour, follows the pointers twice, and contracts the links;
    a link inside a component vanishes. Every step is a join or a grouped minimum over saved tables.
    """
    links = links.where("a is not null and b is not null and a <> b")
    rest = saved(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        both = rest.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(rest.select(F.col("b").alias("node"), F.col("a").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("to"))
        points = saved(least.select("node", F.least("node", "to").alias("component")))
        step = points.select(F.col("node").alias("component"), F.col("component").alias("next"))
        for _ in range(2):
            points = points.join(step, "component").select("node", F.col("next").alias("component"))
        points = saved(points)
        if labels is None:
            labels = points
        else:
            moved = points.select(F.col("node").alias("component"), F.col("component").alias("next"))
            labels = saved(labels.join(moved, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
        to_a = points.select(F.col("node").alias("a"), F.col("component").alias("new_a"))
        to_b = points.select(F.col("node").alias("b"), F.col("component").alias("new_b"))
        moved = rest.join(to_a, "a").join(to_b, "b").where("new_a <> new_b")
        moved = moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        rest = saved(moved.distinct())
        if rest.isEmpty():
            return labels


def linked_groups(
    buckets: DataFrame, attributes: DataFrame, may_link: Callable[[str, str], str], verify: Callable[[DataFrame], DataFrame], turns: int = 2
) -> DataFrame:
    """Components (node, component) of the links that `verify` finds among nodes which share a key.

    buckets: key, node and small columns. attributes: one row per node with what may_link(x, y), an SQL condition
    over x.* and y.* of two rows of a bucket, also needs. verify: pairs (a, b) to true links (a, b). In each turn a bucket's
    nodes are compared with two of them, the least and the greatest by a hash that is the same in all
    buckets (in the first turn the one with the most shared keys instead of the greatest: in a group of edited copies
    that is the text the others were made from, which most of them link with); then only pairs of different components
    are. So a large group of near copies costs its size, not its square, and no link between components is lost.
    """
    ends = buckets.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    ends = saved(ends.where("low <> high").select("key"))
    shared = buckets.join(ends, "key").join(attributes, "node")
    shared = saved(shared.withColumn("met", F.count("*").over(Window.partitionBy("node"))))
    side = F.struct("group", *[c for c in shared.columns if c not in ("key", "met")])

    def new_links(turn: int, groups: DataFrame | None) -> tuple[DataFrame, ...]:
        """Links among pairs of the turn; nothing if no bucket has nodes of two groups."""
        if groups is None:
            placed = shared.withColumn("group", F.col("node"))
        else:
            placed = saved(shared.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component"))
        order = F.xxhash64("node", F.lit(turn)).alias("order")
        least = F.struct(order, side.alias("row"))
        most = F.struct((F.col("met") if turn == 0 else F.lit(0)).alias("met"), order, side.alias("row"))
        heads = placed.groupBy("key").agg(
            F.min(least).alias("x"), F.max(most).alias("z"), F.min("group").alias("low"), F.max("group").alias("high")
        )
        heads = saved(heads.where("low <> high").select("key", "x.row", F.col("z.row").alias("last")))
        if heads.isEmpty():
            return ()
        y = placed.select("key", side.alias("y"))
        if turn < turns:
            tried = y.join(heads, "key")
            pairs = [
                tried.where(f"{x}.group <> y.group and {may_link(x, 'y')}").select(F.col(f"{x}.node").alias("a"), F.col("y.node").alias("b"))
                for x in ("row", "last")
            ]
            pairs = pairs[0].unionByName(pairs[1])
        else:
            open_ = saved(placed.join(heads.select("key"), "key"))
            x, y = (open_.select("key", side.alias(s)) for s in "xy")
            pairs = x.join(y, "key").where(f"x.group < y.group and {may_link('x', 'y')}")
            pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        return (verify(saved(once(pairs))),)

    links, groups = None, None
    for turn in range(turns + 1):
        found = released(new_links, turn, groups)
        if not found:
            break
        links = found[0] if links is None else links.unionByName(found[0])
        (groups,) = released(lambda links: (components(links),), links)
    return groups if groups is not None else shared.select("node", F.col("node").alias("component")).limit(0)


def once(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
