"""Connected components of a table of links, by alternating large and small stars.

Every round hooks each vertex's neighbours to the smallest vertex it sees; rounds end when the links
stand as stars around each component's smallest vertex.  A vertex's neighbours are never gathered: its
smallest one is an aggregate, joined back to its links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rambler.session import materialize


def _hook(links: DataFrame) -> DataFrame:
    """``(u, v)`` links with the smallest vertex ``m`` among u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    return links.join(least, F.col("u") == F.col("of")).select("u", "v", "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(vertex, component)`` of all linked vertices but each component's smallest, which is the component.

    ``links`` has two columns of numbers; self links and repeated links don't matter.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hook(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = materialize(large, "large-star")
        small = _hook(large)
        edges = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
                 .filter("u > v").distinct())
        edges = materialize(edges, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        before = now
