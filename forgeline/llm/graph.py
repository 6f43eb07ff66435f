"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _sum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): the smallest node reachable, for nodes with a link.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Each step aggregates
    the smallest neighbour per node with map-side combining and joins it back to the stored
    links, which AQE may split at a hub. Every step is a written table, so nothing is recomputed when
    executors go, and the driver only compares a count and a checksum.
    """
    oriented = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = materialize(oriented.distinct(), "links")
    before = _sum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = materialize(least.select(F.col("a").alias("node"), F.least("a", "m").alias("m")), "links-least")
        large = both.join(least, F.col("a") == F.col("node")).where(F.col("b") > F.col("a"))
        large = materialize(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links-large")
        least = materialize(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), "links-least")
        small = large.join(least, F.col("a") == F.col("node")).where(F.col("b") != F.col("m"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.distinct(), "links")
        now = _sum(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
