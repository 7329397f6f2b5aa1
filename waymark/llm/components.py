"""Connected components of a large set of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.frames import stage


def parts(rows: int, each: int = 25_000) -> int:
    """Files for a table of ``rows`` rows: a small one is not dealt over all shuffle partitions."""
    return max(8, rows // each)


def _large_star(edges: DataFrame, files: int) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    least = stage(least.coalesce(files), "least")
    return both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, files: int) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u").coalesce(files), "least")
    moved = down.join(least, F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _is_forest(edges: DataFrame) -> bool:
    """Every node has one link, to a node that has none."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("b").alias("u"), F.lit(0).alias("out"))
    )
    # A node is a leaf with one row of its own, or a root with none; a root's rows all say 0.
    worst = ends.groupBy("u").agg(F.sum("out").alias("outs"), F.count("*").alias("n"))
    return worst.filter("outs > 1 OR outs = 1 AND n > 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """node and component (smallest node it reaches) of every node in ``edges`` (a, b; longs).

    Each step is written to the shared folder and read back. Minima are combined before
    the shuffle, and the joins are on scanned tables, so a node with very many links is
    split by adaptive execution. Rows with a null, loops and repeated links are ignored.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a <> b AND a IS NOT NULL AND b IS NOT NULL"
    )
    edges = stage(edges.distinct(), "links")
    files = parts(edges.count())
    while not _is_forest(edges):
        edges = stage(_large_star(edges, files).distinct().coalesce(files), "links")
        edges = stage(_small_star(edges, files).distinct().coalesce(files), "links")
    # In a forest of stars the centre may be any node of its star, so take the smallest.
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("root"), F.least("b", "m").alias("component"))
    leaves = edges.join(least, F.col("b") == F.col("root")).select(F.col("a").alias("node"), "component")
    return leaves.unionByName(least.select(F.col("root").alias("node"), "component"))


def joined(found: DataFrame, edges: DataFrame) -> DataFrame:
    """``found`` (node, component) after more links: only the components they touch are worked on."""
    known = found.select(F.col("node").alias("n"), F.col("component").alias("c"))
    of_a = edges.join(known, F.col("a") == F.col("n"), "left").select(F.coalesce("c", "a").alias("ca"), "b")
    of_both = of_a.join(known, F.col("b") == F.col("n"), "left").select(F.col("ca").alias("a"), F.coalesce("c", "b").alias("b"))
    up = stage(components(of_both).select(F.col("node").alias("old"), F.col("component").alias("new")), "joined")
    # Nodes that had no component come in under their own name.
    fresh = up.select(F.col("old").alias("node")).join(found.select("node"), "node", "left_anti")
    every = found.unionByName(fresh.withColumn("component", F.col("node")))
    return every.join(up, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
