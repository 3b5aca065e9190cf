"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Each step replaces edges by edges to the smallest neighbour, found with an
    aggregate and joined back, so a node with very many neighbours is never
    gathered in one place.  Every round is a written table; rounds end when the
    edges no longer change.  NULL ends and loops are left out.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = _written(links)
    while True:
        after = _written(_small_star(_large_star(now.frame)))
        same = (after.rows, after.totals["_sum"]) == (now.rows, now.totals["_sum"])
        now.drop()
        now = after
        if same:
            break
    stars = now.frame
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(stars.select("v", "v").distinct())


def _written(edges: DataFrame) -> Table:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return Table(edges, "components", _sum=digest)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node link to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = edges.union(edges.select("v", "u")).groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()
