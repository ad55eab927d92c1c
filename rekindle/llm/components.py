"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rekindle.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v) plus the smallest node of u's neighbourhood (u included), by aggregate and join, not by window."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v"), F.col("u")).toDF("u", "v"))
    return (_with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge points from the larger to the smaller node here."""
    x = _with_least(edges)
    out = x.select("v", "m").toDF("u", "v").union(x.select("u", "m").toDF("u", "v"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of ``edges`` (two bigint columns u, v) but the roots; root: the smallest node reachable.

    Every round is written to the shared folder.  It ends when the links form
    stars, after a few rounds (logarithmic in the longest chain).
    """
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct(), f"{name}-0")
    k = 0
    while True:
        k += 1
        # stars: every node with a link downwards has one only, and its target has none
        loose = e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() \
            or e.select("u").join(e.select(F.col("v").alias("u")).distinct(), "u").limit(1).count()
        if not loose:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        e = written(_small_star(_large_star(e)), f"{name}-{k}")
