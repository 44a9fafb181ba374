"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...scratch import Scratch


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every u once, and no v that is a u: u → smallest vertex is final."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    inner = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return twice.unionByName(inner).isEmpty()


def star_components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """Undirected links → (id, component): every linked vertex but the smallest
    of its component, with that smallest one.

    The number of rounds grows with the logarithm of the longest path; they end
    when all edges are stars, whose centre is the smallest vertex.  A vertex of any degree costs one partial
    aggregate per task and a join that the runtime can split.  Each round is a
    written table, and its predecessor is deleted.  Self-links and nulls are
    ignored.
    """
    scratch = scratch or Scratch(links.sparkSession, "components")
    e = scratch.write(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .distinct(), "edges")
    while not _is_forest_of_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.write(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        nxt = scratch.write(small, "small")
        scratch.drop(e, large)
        e = nxt
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
