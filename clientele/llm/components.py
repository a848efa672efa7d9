"""Connected components of a link table, by alternating large-star and small-star steps.

Each step replaces links by links to the smallest neighbour: a count of links per node is never gathered anywhere, a
node with very many links is reduced before the shuffle, and the links are written to the shared folder after each
round, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour instead."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` of every node that has a link; ``links`` has two long columns ``a`` and ``b``.

    A component is named by its smallest node. Links of a node to itself and repeated links do no harm; links with a
    null end are ignored; without links the result is empty.
    """

    def digest(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = scratch.save(links.select("a", "b").where("a <> b").distinct())
    before = None
    while (state := digest(now)) != before and state[0]:
        before = state
        following = scratch.save(_small_star(_large_star(now).distinct()).distinct())
        scratch.drop(now)
        now = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
