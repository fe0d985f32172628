"""Connected components of an edge table, by alternating large and small stars.

Every round is joins and grouped minima over (node, node) rows, stored in the
shared folder; a round reaches twice as far. No edge or label comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges ``a``, ``b``; a component's name is its smallest node."""
    links = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                    .filter("hi <> lo").distinct(), "links")
    while not are_stars(links):
        links = written(small_star(large_star(links)), "links")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def are_stars(links: DataFrame) -> bool:
    """Whether each node points at one node that points nowhere, which is then the smallest of its component."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in_")).unionByName(
        links.select(F.col("lo").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in_")))
    met = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in_").alias("in_"))
    return met.filter("out > 1 OR (out = 1 AND in_ = 1)").isEmpty()


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found``, which has every node, after the ends ``a``, ``b`` of each link lie in one component.

    Only the components that links touch are worked on.
    """
    ends = links
    for end in ("a", "b"):
        named = found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        ends = ends.join(named, end)
    touched = components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    moved = touched.select(F.col("node").alias("component"), F.col("component").alias("_new"))
    return found.join(moved, "component", "left").select("node", F.coalesce("_new", "component").alias("component"))


def large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours now point at the smallest of its neighbours and itself."""
    both = links.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
        links.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("other")).select(
        "node", F.least("node", "other").alias("least"))
    return (both.filter("other > node").join(least, "node")
            .select(F.col("other").alias("hi"), F.col("least").alias("lo")).filter("hi <> lo").distinct())


def small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours now point at the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    met = links.join(least, "hi")
    moved = met.select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).filter("hi <> lo").distinct()
