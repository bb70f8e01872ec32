"""Connected components of a link table, by contraction.

Every round puts the nodes in a new random order, hooks each to its first
neighbour if that comes before it, follows the hooks a few steps, and
replaces the ends of all links by what they were hooked to. In a random
order chains of hooks are short, so also long paths shrink by a factor every
round. A hub's neighbours are reduced by partial aggregates, never gathered.
The driver sees one bit a round: whether links are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.common import Scratch


def relabel(table: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """Replace ``column`` by the node it is hooked to, if any."""
    return (table.join(hooks.select(F.col("node").alias(column), "hook"), column, "left")
            .withColumn(column, F.coalesce("hook", column)).drop("hook"))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) longs -> (node, component) for every node of a link between
    different nodes; ``component`` is one node of the component, the same
    for all of it. Nulls and self links are ignored; an empty table gives
    an empty table."""
    links = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .where("a <> b").distinct())
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = scratch.save(ends.withColumn("component", F.col("node")))
    turn = 0
    while links.limit(1).count():
        turn += 1
        place = lambda node: F.struct(F.xxhash64(node, F.lit(turn)).alias("rank"), F.col(node).alias("node"))
        both = links.select("a", "b").union(links.select("b", "a"))
        hooks = scratch.save(both.groupBy("a").agg(F.min(place("b")).alias("first"))
                             .select(F.col("a").alias("node"), F.least(place("a"), F.col("first"))["node"].alias("hook")))
        step = hooks
        for _ in range(3):
            step = _follow(step, hooks)
        step = scratch.save(step.where("node <> hook"))
        more = scratch.save(relabel(relabel(links, "a", step), "b", step).where("a <> b")
                            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                            .distinct())
        new = scratch.save(relabel(labels, "component", step))
        scratch.drop(links, labels, hooks, step)
        links, labels = more, new
    return labels


def _follow(step: DataFrame, hooks: DataFrame) -> DataFrame:
    nexts = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("then"))
    return (step.join(nexts, "hook", "left")
            .select("node", F.coalesce("then", "hook").alias("hook")))
