"""Connected components of a table of links, by large-star and small-star
steps: every step is two aggregations and joins on vertex ids, nothing but a
changed-or-not count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import keep


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``links (a, b)`` (64-bit ids): ``root``
    is the least id of its component.  Loops and repeated links do no harm."""
    edges = keep(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        edges = keep(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and tuple(state) == before:
            break
        before = tuple(state)
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("b").alias("root"))).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a vertex is linked to the vertex's least
    neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """The lesser neighbours of a vertex, and the vertex, are linked to the
    least of them (edges run from the greater to the lesser id)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    down = joined.filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
