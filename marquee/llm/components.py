"""Connected components of a distributed edge list (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch, discard, stored


def _star(edges: DataFrame, large: bool, scratch: Scratch) -> DataFrame:
    """One star operation on edges (a > b). Large: every neighbour above a node
    is pointed at the least of the node and its neighbours. Small: every
    neighbour below it, and itself, are.

    The least neighbours are a table of their own, so that both sides of the join
    with them are shuffled and AQE can split a hub."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        least = scratch.written(least, "least-neighbours")
        out = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("w").alias("b"))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = scratch.written(both.groupBy("u").agg(F.min("v").alias("w")), "least-neighbours")
        out = both.join(least, "u").filter("v <> w").select(F.col("v").alias("a"), F.col("w").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("w").alias("b"))
        )
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> (node, component), the component being the
    smallest node reached; nodes without an edge to another node are absent.

    Each round is two star operations (Kiveris et al., "Connected Components in
    MapReduce and Beyond", 2014): a partially aggregated minimum per node and an
    equi-join back, which AQE splits where a hub is hot. The rounds -- some
    log(n) of them -- end when the edge set no longer changes; every round is a
    written table, and those before it are removed. Null ends and self-loops are ignored."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a IS NOT NULL AND b IS NOT NULL AND a <> b"
    )
    spark, path, before = edges.sparkSession, None, None
    with Scratch(spark) as scratch:
        current = scratch.written(pairs.distinct(), "links")
        while True:
            larger = scratch.written(_star(current, True, scratch), "stars")
            seen = Observation()
            made = _star(larger, False, scratch).observe(
                seen, F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
            )
            last, path = path, stored(made, "components")
            current = spark.read.schema("a long, b long").parquet(path)
            scratch.done("least-neighbours", "stars", "links")
            if last:
                discard(spark, last)
            now = seen.get
            if now == before:
                return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            before = now
