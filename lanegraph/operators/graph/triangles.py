"""Local clustering on the undirected simple graph.

Triangles are listed with the degree-ordered orientation: every edge points
from the lower-ranked endpoint (degree, id) to the higher one, so a vertex
only pairs its *higher-ranked* neighbours.  A hub has few higher-ranked
neighbours, which bounds the wedges any one vertex produces by O(√m).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import both_directions, undirected_simple


def triangle_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    und = undirected_simple(edges)
    adj = both_directions(und)
    deg = adj.groupBy(F.col("u").alias("id")).agg(F.count("*").alias("deg"))
    rank = F.struct(F.col("deg"), F.col("id"))
    r = deg.select("id", rank.alias("rk"))
    oriented = (und.join(r.withColumnRenamed("id", "a").withColumnRenamed("rk", "ra"), "a")
                .join(r.withColumnRenamed("id", "b").withColumnRenamed("rk", "rb"), "b")
                .select(F.when(F.col("ra") < F.col("rb"), F.col("a")).otherwise(F.col("b")).alias("x"),
                        F.when(F.col("ra") < F.col("rb"), F.col("b")).otherwise(F.col("a")).alias("y"),
                        F.greatest("ra", "rb").alias("ry")))
    # wedge x->y, x->z with y < z in rank order, closed by y->z
    o1 = oriented.select(F.col("x"), F.col("y").alias("p"), F.col("ry").alias("rp"))
    o2 = oriented.select(F.col("x"), F.col("y").alias("q"), F.col("ry").alias("rq"))
    wedges = o1.join(o2, "x").where(F.col("rp") < F.col("rq"))
    tri = wedges.join(oriented.select(F.col("x").alias("p"), F.col("y").alias("q")), ["p", "q"])
    per_vertex = (tri.select(F.explode(F.array("x", "p", "q")).alias("id"))
                  .groupBy("id").agg(F.count("*").alias("triangles")))
    return (vertices.select("id").join(deg, "id", "left").join(per_vertex, "id", "left")
            .select("id", F.coalesce("deg", F.lit(0)).alias("deg"),
                    F.coalesce("triangles", F.lit(0)).alias("triangles")))


def clustering(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """c(v) = 2·T(v) / (deg(v)·(deg(v)−1)); degree < 2 → 0."""
    t = triangle_counts(vertices, edges)
    return t.select("id", F.when(F.col("deg") > 1, 2.0 * F.col("triangles") /
                                 (F.col("deg") * (F.col("deg") - 1))).otherwise(F.lit(0.0)).alias("clustering"))
