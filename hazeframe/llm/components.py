"""Connected components of a link table by alternating stars.

Every round replaces each link by one to a smaller neighbour, first for larger
neighbours, then for smaller ones, until all links of a component point at its
smallest node.  All work is joins and grouped minima; no group is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a != b")


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    near = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _is_done(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none."""
    ends = links.select("a", F.lit(1).alias("out"), F.lit(0).alias("to")).union(links.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("a").agg(F.sum("out").alias("out"), F.max("to").alias("to"))
    return ends.where("out > 1 OR out = 1 AND to = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node of the component) of all linked nodes.

    ``links`` has the columns ``a`` and ``b``; loops and nulls are left out, an
    empty table gives an empty result.
    """
    low = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        low = common.store(_small_star(_large_star(low)), "links")
        if _is_done(low):
            break
    return low.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        low.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
