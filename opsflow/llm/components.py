"""Connected components by alternating large-star and small-star.

No neighbour list is ever collected: the smallest neighbour of a node is a
partial aggregate, and the edges are rewired by a join with it, so a node with
a third of all edges stays spread (AQE splits the join; the aggregate combines
before the shuffle).  The links are evaluated once, and every star is written to
shared scratch by itself, so no plan holds more than one self-join: the driver
plans and keeps little, however many rounds there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import write_and_read


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most and only roots have larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0] == 0


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of the links ``a``, ``b``.

    Direction, repeats and loops of links do not matter; links with a null end
    are ignored; no links give an empty table.
    """
    edges = (links.filter("a is not null and b is not null")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = write_and_read(edges, "cc")
    loops = edges.filter("a = b").select(F.col("a").alias("node"))
    edges = edges.filter("a > b")
    while not _settled(edges):
        edges = write_and_read(_large_star(edges), "cc")
        edges = write_and_read(_small_star(edges), "cc")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = stars.select(F.col("component").alias("node")).unionAll(loops).distinct()
    roots = own.join(stars, "node", "left_anti").select("node", F.col("node").alias("component"))
    return stars.unionAll(roots)
