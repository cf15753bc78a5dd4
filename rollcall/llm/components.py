"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    return (
        both.join(least, F.col("a") == F.col("n"))
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", "n").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("n")).filter(F.col("b") != F.col("m"))
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that isn't its own.

    ``links`` has two columns of longs. Each round writes its links, which only
    shrink; the number of rounds grows with the logarithm of the longest path. A
    node with very many links is a skewed join key and is split as such.
    """
    a, b = links.columns
    edges = materialize(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(materialize(_large_star(edges), "links")), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
