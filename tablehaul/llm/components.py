"""Connected components of a graph given by its links, by alternating large and small stars.

Each round hangs the neighbours of a node under the smallest of them. Rounds grow with the
logarithm of the longest chain; each is written to the shared folder. A node's neighbours are
never gathered in one place: minima are aggregated before they are shuffled, and joins on a
node with many links are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that has a link.

    ``links`` has the columns a and b of one orderable type; links to oneself are ignored.
    """
    stars = durable(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    while not _done(stars):
        stars = durable(_small_star(_large_star(stars)), "links")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.where("v > u").join(least, "u")
    return moved.select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _done(links: DataFrame) -> bool:
    """Every node hangs under one root, and no root hangs under another."""
    child = links.groupBy("a").count()
    nested = links.join(child.select(F.col("a").alias("b")), "b", "left_semi").select("a")
    return child.where("count > 1").select("a").unionByName(nested).isEmpty()
