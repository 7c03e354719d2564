"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropweave.llm._common import dealt
from dropweave.session import stage


def _pointed(edges: DataFrame, rows: int) -> DataFrame:
    """Each end's smallest neighbour (its own id included), joined to the ends; dealt by end once for both."""
    by_end = dealt(edges, rows, "u")
    low = by_end.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return by_end.join(low, "u")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a`` and ``b``); the component is its smallest node.

    A round hangs every larger neighbour of a node on the smallest one, then every smaller one.  Minima are taken before
    the join and joined back as one row per node; the number of tasks follows the number of links.  Rounds grow with the logarithm of
    the longest chain and are cut by staged tables.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "links")
    size, state = edges.count(), None
    edges = dealt(edges, size, "u").distinct()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(_pointed(both, 2 * size).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"), "large-star")
        small = _pointed(large, large.count())
        ends = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stage(dealt(ends, 2 * size, "u").distinct(), "small-star")
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        size, state = found[0], found
    nodes = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
                                           F.struct(F.col("v").alias("node"), F.col("v").alias("component")))).alias("n")).select("n.*")
    return dealt(nodes, 2 * size, "node").distinct()
