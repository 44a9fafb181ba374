"""Registered queries: facility graph, centralities, structure, embeddings and
the hub-level decision views built on them.

Every query builds the training graph from the tables it is given.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import decision as D
from ..operators.graph import centrality as C
from ..operators.graph import community as CM
from ..operators.graph import core as G
from ..operators.graph import cuts as X
from ..operators.graph import stats as S
from ..operators.graph import triangles as T
from ..operators.graph import walks as W
from .registry import above_ties, finish, legs, query


def facilities(spark, sf_dir):
    return A.facility_stats(legs(spark, sf_dir).where(F.col("data") == "training"))


def graph(spark, sf_dir):
    tr = legs(spark, sf_dir).where(F.col("data") == "training")
    v, e = G.facility_graph(*A.network_tables(tr))
    return G.cut(v), G.cut(e)


def cent(v, e):
    return G.cut(S.centralities(v, e))


def crit(v, e):
    return tuple(G.cut(x) for x in X.critical_infrastructure(v, e))


def comm(v, e):
    return G.cut(CM.communities(v, e))


def impact(v, e):
    return G.cut(S.impact_scores(v, cent(v, e)))


def embeddings(v, e):
    return G.cut(W.node_embeddings(v, e))


# ------------------------------------------------------------------ with oracles

@query("graph_facility")
def _g_edges(spark, sf_dir):
    _, e = graph(spark, sf_dir)
    return finish(e.select("src", "dst", "weight", "distance", "frequency", "delay_class"))


@query("degree_centrality")
def _deg(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(C.degree_centrality(v, e))


@query("pagerank")
def _pr(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(C.pagerank(v, e).withColumnRenamed("pr", "pagerank"))


@query("closeness_centrality")
def _close(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(C.closeness_centrality(v, e))


@query("closeness_sketched")
def _close_sketched(spark, sf_dir):
    return finish(C.hyperball(*graph(spark, sf_dir), p=12))


@query("clustering")
def _clust(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(T.clustering(v, e))


@query("connected_components")
def _cc(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return G.connected_components(v.select("id"), G.undirected_simple(e))


@query("graph_neighbor_stats")
def _nbr(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(S.neighbour_stats(v, e))


@query("core_subgraph")
def _core(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    _, ce = S.core_subgraph(v, e, keep=60)
    return ce.select("src", "dst")


@query("graph_route_type")
def _g_rt(spark, sf_dir):
    rc = A.route_type_corridors(legs(spark, sf_dir).where(F.col("data") == "training"))
    _, e = G.route_type_graph(rc)
    return finish(above_ties(e.select("route_type", "src", "dst", "frequency", "weight"), "weight"))


@query("graph_route_type_nodes")
def _g_rtn(spark, sf_dir):
    rc = A.route_type_corridors(legs(spark, sf_dir).where(F.col("data") == "training"))
    return G.route_type_graph(rc)[0].select("route_type", "id")


@query("walk_expected_visits")
def _expected(spark, sf_dir):
    return finish(W.expected_visits(*graph(spark, sf_dir), walk_length=20, num_walks=50))


@query("attach_metrics")
def _attach(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(S.attach_metrics(v.select("id", "name", "type", "throughput"), cent(v, e), comm(v, e)))


# ------------------------------------------------------ property-checked (no SQL)

@query("betweenness_centrality")
def _bc(spark, sf_dir):
    return finish(cent(*graph(spark, sf_dir)).select("id", "betweenness"))


@query("betweenness_sampled")
def _bc_sampled(spark, sf_dir):
    """Few hubs: every source is used and the bound is 0; sampling begins with larger graphs."""
    return finish(C.sampled_betweenness(*graph(spark, sf_dir), eps=0.05))


@query("articulation_points")
def _aps(spark, sf_dir):
    return crit(*graph(spark, sf_dir))[0]


@query("bridges")
def _bridges(spark, sf_dir):
    return crit(*graph(spark, sf_dir))[1]


@query("communities")
def _comm(spark, sf_dir):
    return comm(*graph(spark, sf_dir))


@query("communities_greedy")
def _comm_greedy(spark, sf_dir):
    return G.cut(CM.greedy_communities(*graph(spark, sf_dir), refine=False))


@query("modularity_greedy")
def _mod_greedy(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(CM.modularity(G.undirected_simple(e, "weight"), G.cut(CM.greedy_communities(v, e, refine=False))))


@query("graph_statistics")
def _gstats(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(S.graph_statistics(v, e, cent(v, e)))


@query("impact_score")
def _impact(spark, sf_dir):
    return finish(D.hub_severity(impact(*graph(spark, sf_dir))), 6)


@query("top_bottleneck_hubs")
def _top_hubs(spark, sf_dir):
    i = finish(impact(*graph(spark, sf_dir)).select("facility_id", "name", "impact_score_normalized", "throughput",
                                            "sla_breach_pct"), 6)
    return i.orderBy(F.desc("impact_score_normalized"), "facility_id").limit(10)


@query("dependency_score")
def _dep(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    degrees = v.select(F.col("id").alias("facility_id"), F.col("out_degree_custom").alias("out_degree"))
    return finish(S.dependency_score(impact(v, e), degrees)
                  .select("facility_id", "dependency_score"), 6)


@query("network_summary")
def _summary(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    aps, br = crit(v, e)
    return finish(S.network_summary(v, e, cent(v, e), comm(v, e), aps, br))


@query("modularity")
def _mod(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(CM.modularity(G.undirected_simple(e, "weight"), comm(v, e)))


@query("bottleneck_kpis")
def _kpis(spark, sf_dir):
    tr = legs(spark, sf_dir).where(F.col("data") == "training")
    return finish(D.bottleneck_kpis(impact(*graph(spark, sf_dir)), A.corridor_impact(A.corridor_stats(tr, False))))


@query("sla_penalty_kpis")
def _penalty(spark, sf_dir):
    return finish(D.sla_penalty_kpis(impact(*graph(spark, sf_dir))), 3)


@query("hub_scenarios")
def _hub_scen(spark, sf_dir):
    return finish(above_ties(D.hub_scenarios(impact(*graph(spark, sf_dir))), "net_first_year_lakh", "annual_recovery_lakh"), 4)


@query("random_walks")
def _walks(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return W.random_walk_visits(v, e)


@query("random_walks_second_order")
def _walks2(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return W.random_walk_visits(v, e, p=1.0, q=2.0)


@query("walk_cooccurrence")
def _cooc(spark, sf_dir):
    v, e = graph(spark, sf_dir)
    return finish(W.walk_cooccurrence(W.random_walk_visits(v, e)))


@query("embeddings")
def _emb(spark, sf_dir):
    return finish(embeddings(*graph(spark, sf_dir)))


@query("merge_graph_features")
def _merge(spark, sf_dir):
    from .analysis_q import features
    v, e = graph(spark, sf_dir)
    gs = S.graph_statistics(v, e, cent(v, e))
    m = S.merge_graph_features(features(spark, sf_dir), embeddings(v, e), gs)
    return finish(m.select("trip_uuid", *[c for c in m.columns if c.startswith(("src_", "dst_"))]))
