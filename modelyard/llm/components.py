"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.session import discard, written

MAX_ROUNDS = 60


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest vertex around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _nearest(both).select("a", F.least("a", "m").alias("m"))
    return (
        both.filter(F.col("b") > F.col("a"))
        .join(low, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a > b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex, are tied to the smallest one."""
    low = _nearest(links)
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every vertex of links (a, b): the smallest id it reaches.

    Rows are long ids, in any order, repeated or not; loops are ignored. A round ends in a
    written table, so a lost executor costs one round. Vertices without links are absent.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct(),
        "links",
    )
    mark = None
    for _ in range(MAX_ROUNDS):
        before, links = links, written(_small_star(_large_star(links)), "links")
        discard(before)
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    low = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(low)
