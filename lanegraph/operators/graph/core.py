"""Graph representation and shared helpers.

A graph is a pair of DataFrames: ``vertices(id, …)`` and
``edges(src, dst, weight, …)`` (directed, at most one edge per ordered
pair).  Iterative algorithms run one DataFrame round per step; each round is
written to the session's shared folder and read back, so a lost executor costs
at most a round and the next plan starts from real file sizes (a checkpoint
keeps the estimates of the old plan, which double with every join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...scratch import Scratch
from .components import star_components


def cut(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back."""
    return Scratch(df.sparkSession, "graph").write(df, "round")


def discard(*tables: DataFrame) -> None:
    """Delete superseded results of ``cut``."""
    for t in tables:
        path = getattr(t, "_scratch_path", None)
        if path:
            from ...scratch import remove_path
            remove_path(t.sparkSession, path)


def sorted_index(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """Attach a 0-based position in a global sort.

    A range-partitioned sort numbers the rows of each partition; the partition
    sizes, one row per partition, are added up and broadcast as offsets.
    """
    ordered = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)       # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, place + F.col("_before")).drop("_at", "_part", "_before"))


def facility_graph(facilities: DataFrame, corridors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices from facility stats, edges from corridor stats (weight = mean delay ratio)."""
    v = facilities.select(
        F.col("facility_id").alias("id"), F.col("facility_name").alias("name"),
        F.col("facility_type").alias("type"), F.col("total_throughput").alias("throughput"),
        F.col("in_degree").alias("in_degree_custom"), F.col("out_degree").alias("out_degree_custom"),
        "avg_delay", "sla_breach_pct", "total_degree")
    e = corridors.select(
        F.col("source_center").alias("src"), F.col("destination_center").alias("dst"),
        F.col("osrm_distance_mean").alias("distance"), F.col("osrm_time_mean").alias("osrm_time"),
        "actual_time_mean", F.col("delay_ratio_mean").alias("delay_ratio"),
        F.col("trip_count").alias("frequency"), F.col("corridor_reliability").alias("reliability"),
        "sla_breach_pct", F.coalesce(F.col("delay_class"), F.lit("Unknown")).alias("delay_class"),
        F.col("primary_route_type").alias("route_type"),
        F.coalesce(F.col("delay_ratio_mean"), F.lit(1.0)).alias("weight"))
    # endpoints missing from the vertex table still become vertices (as add_edge does)
    ends = e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    v = v.join(ends, "id", "full_outer")
    return v, e


def route_type_graph(route_corridors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FTL / Carting graphs in one table pair keyed by ``route_type``."""
    e = route_corridors.select("route_type", F.col("source_center").alias("src"),
                               F.col("destination_center").alias("dst"), "actual_time", "osrm_time",
                               "distance", "delay_ratio", "frequency", "weight")
    v = (e.select("route_type", F.col("src").alias("id"))
         .union(e.select("route_type", F.col("dst").alias("id"))).distinct())
    return v, e


def undirected_simple(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """Undirected edges ``(a < b)`` without self-loops; reciprocal corridors
    collapse to one edge whose weight is the sum of both directions."""
    e = edges.where(F.col("src") != F.col("dst"))
    a = F.least("src", "dst")
    b = F.greatest("src", "dst")
    if weight is None:
        return e.select(a.alias("a"), b.alias("b")).distinct()
    return e.groupBy(a.alias("a"), b.alias("b")).agg(F.sum(weight).alias("w"))


def both_directions(und: DataFrame, extra=()) -> DataFrame:
    """Adjacency rows ``(u, v)`` for every undirected edge, both ways."""
    cols = list(extra)
    return (und.select(F.col("a").alias("u"), F.col("b").alias("v"), *cols)
            .union(und.select(F.col("b").alias("u"), F.col("a").alias("v"), *cols)))


def connected_components(vertex_ids: DataFrame, und: DataFrame) -> DataFrame:
    """Undirected edges ``(a, b)`` → ``(id, component)``, the component being
    its smallest vertex; star rounds until nothing changes."""
    stars = star_components(und)
    return (vertex_ids.select("id").join(stars, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))
