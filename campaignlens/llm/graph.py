"""Connected components of a large set of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlens.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; the root is the component's smallest node.

    Every round points each node at its smallest neighbour, follows the
    pointers to their ends, and contracts the links to the ends they join.  A
    star takes one round; the number of components that still touch falls at
    least by half each round.  Rounds are stored, so lineage stays short.
    """
    left = store(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    roots: DataFrame | None = None
    while left.limit(1).count():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node")
        near = _to_ends(store(near))
        roots = near if roots is None else store(_follow(roots, near))
        ends_a = near.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        ends_b = near.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = store(
            left.join(ends_a, "a")
            .join(ends_b, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).where(F.lit(False))
    return roots


def _follow(roots: DataFrame, near: DataFrame) -> DataFrame:
    step = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _to_ends(near: DataFrame) -> DataFrame:
    """Pointers followed until they rest (the distance doubles each time)."""
    while True:
        step = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = near.join(step, "root")  # every root is a node
        if not moved.where("next <> root").limit(1).count():
            return near
        near = store(moved.select("node", F.col("next").alias("root")))
