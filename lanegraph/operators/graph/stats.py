"""Per-facility graph statistics, impact scores and the network summary.

Centralities are computed once and joined; nothing is recomputed per use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..aggregate import one_row_join
from . import centrality as C
from . import triangles as T


def neighbour_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Successor aggregates: mean/max avg_delay, mean throughput, mean out-edge
    weight and distance, successor count (0 when a vertex has none)."""
    succ = edges.select("src", "dst", "weight", "distance").join(
        vertices.select(F.col("id").alias("dst"), "avg_delay", "throughput"), "dst", "left")
    g = succ.groupBy(F.col("src").alias("id")).agg(
        F.avg("avg_delay").alias("graph_nbr_avg_delay"), F.max("avg_delay").alias("graph_nbr_max_delay"),
        F.avg("throughput").alias("graph_nbr_avg_throughput"), F.avg("weight").alias("graph_avg_edge_weight"),
        F.avg("distance").alias("graph_avg_edge_distance"), F.count("*").alias("graph_num_neighbors"))
    cols = [c for c in g.columns if c != "id"]
    return (vertices.select("id").join(g, "id", "left")
            .select("id", *[F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c)
                            for c, t in g.dtypes if c in cols]))


def centralities(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    deg = C.degree_centrality(vertices, edges)
    pr = C.pagerank(vertices, edges)
    bc = C.betweenness_centrality(vertices, edges)
    cl = C.closeness_centrality(vertices, edges)
    cc = T.clustering(vertices, edges)
    return (deg.join(pr, "id").join(bc, "id").join(cl, "id").join(cc, "id")
            .withColumnRenamed("pr", "pagerank"))


def graph_statistics(vertices: DataFrame, edges: DataFrame, cent: DataFrame) -> DataFrame:
    nb = neighbour_stats(vertices, edges)
    return cent.join(nb, "id").select(
        F.col("id").alias("facility_id"),
        F.col("degree_centrality").alias("graph_degree"), F.col("in_degree_centrality").alias("graph_in_degree"),
        F.col("out_degree_centrality").alias("graph_out_degree"), F.col("betweenness").alias("graph_betweenness"),
        F.col("pagerank").alias("graph_pagerank"), F.col("clustering").alias("graph_clustering"),
        "graph_nbr_avg_delay", "graph_nbr_max_delay", "graph_nbr_avg_throughput", "graph_avg_edge_weight",
        "graph_avg_edge_distance", "graph_num_neighbors")


def impact_scores(vertices: DataFrame, cent: DataFrame) -> DataFrame:
    """(0.3·betweenness + 0.2·pagerank)·(0.25·avg_delay + 0.15·sla + 0.1·log1p(throughput)),
    normalised to 0-100 by the maximum (all 0 when the maximum is 0)."""
    v = vertices.select("id", "name", "type", F.coalesce("throughput", F.lit(0)).alias("throughput"),
                        F.coalesce("avg_delay", F.lit(0.0)).alias("avg_delay"),
                        F.coalesce("sla_breach_pct", F.lit(0.0)).alias("sla_breach_pct"))
    s = v.join(cent.select("id", "betweenness", "pagerank"), "id", "left").fillna(0.0, ["betweenness", "pagerank"])
    s = s.withColumn("impact_score", (F.col("betweenness") * 0.3 + F.col("pagerank") * 0.2)
                     * (F.col("avg_delay") * 0.25 + F.col("sla_breach_pct") * 0.15
                        + F.log1p(F.col("throughput")) * 0.1))
    mx = s.agg(F.max("impact_score").alias("_mx"))
    return (one_row_join(s, mx)
            .withColumn("impact_score_normalized",
                        F.when(F.col("_mx") > 0, F.col("impact_score") / F.col("_mx") * 100).otherwise(F.lit(0.0)))
            .drop("_mx").withColumnRenamed("id", "facility_id"))


def dependency_score(impact: DataFrame, facilities: DataFrame) -> DataFrame:
    """throughput · out_degree · score / 100000 with the real out-degree."""
    return (impact.join(facilities.select("facility_id", "out_degree"), "facility_id", "left")
            .withColumn("dependency_score", F.col("throughput") * F.coalesce("out_degree", F.lit(0))
                        * F.col("impact_score_normalized") / 100000))


def network_summary(vertices: DataFrame, edges: DataFrame, cent: DataFrame, community: DataFrame,
                    aps: DataFrame, bridges: DataFrame) -> DataFrame:
    nv = vertices.agg(F.count("*").alias("num_nodes"))
    ne = edges.agg(F.count("*").alias("num_edges"))
    nc = community.agg(F.count_distinct("community").alias("num_communities"))
    na = aps.agg(F.count("*").alias("num_articulation_points"))
    nbr = bridges.agg(F.count("*").alias("num_bridges"))
    cl = cent.agg(F.avg("clustering").alias("avg_clustering"))
    out = one_row_join(one_row_join(one_row_join(one_row_join(one_row_join(nv, ne), nc), na), nbr), cl)
    return out.withColumn("density", F.when(F.col("num_nodes") > 1, F.col("num_edges")
                                            / (F.col("num_nodes") * (F.col("num_nodes") - 1)).cast("double"))
                          .otherwise(F.lit(0.0)))


def core_subgraph(vertices: DataFrame, edges: DataFrame, keep: int = 350) -> tuple[DataFrame, DataFrame]:
    """The ``keep`` vertices of highest degree (ties: smaller id) and the edges
    among them (induced subgraph, two semi-joins); the limit is the feature."""
    deg = C.degree_centrality(vertices, edges)
    top = deg.orderBy(F.desc(F.col("in_deg") + F.col("out_deg")), "id").limit(keep).select("id")
    v = vertices.join(top, "id", "left_semi")
    e = (edges.join(top.withColumnRenamed("id", "src"), "src", "left_semi")
         .join(top.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return v, e


def attach_metrics(vertices: DataFrame, cent: DataFrame, community: DataFrame) -> DataFrame:
    """One vertex table with all metrics and the community; missing metrics are 0."""
    metrics = [c for c in cent.columns if c not in ("id", "in_deg", "out_deg")]
    return (vertices.join(cent.select("id", *metrics), "id", "left").fillna(0.0, metrics)
            .join(community, "id", "left"))


def merge_graph_features(trips: DataFrame, embeddings: DataFrame, gstats: DataFrame) -> DataFrame:
    """Source/destination embeddings and graph stats with ``src_``/``dst_`` prefixes, missing → 0.

    The right sides have one row per facility; the join strategy is left to
    AQE's measured sizes.
    """
    out = trips
    for table in (embeddings, gstats):
        feats = [c for c in table.columns if c != "facility_id"]
        for pre, key in (("src_", "source_center"), ("dst_", "destination_center")):
            t = table.select(F.col("facility_id").alias(key), *[F.col(c).alias(pre + c) for c in feats])
            out = out.join(t, key, "left")
            out = out.fillna(0, [pre + c for c in feats])
    return out
