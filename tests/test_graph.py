"""Graph operators against brute-force answers on small fixtures."""

import random

import pytest

import graph_ref as R
from lanegraph.operators.graph import centrality as C
from lanegraph.operators.graph import community as CM
from lanegraph.operators.graph import cuts as X
from lanegraph.operators.graph import triangles as T
from lanegraph.operators.graph import walks as W


def _graph(spark, edges, nodes=None):
    nodes = nodes or sorted({u for u, _, _ in edges} | {v for _, v, _ in edges})
    v = spark.createDataFrame([(n,) for n in nodes], "id string")
    e = spark.createDataFrame(edges, "src string, dst string, weight double")
    return nodes, v, e


def _undirected(pairs):
    return [(a, b, 1.0) for a, b in pairs] + [(b, a, 1.0) for a, b in pairs]


@pytest.fixture(scope="module")
def rand_graph(spark):
    random.seed(7)
    nodes = [f"n{i}" for i in range(10)]
    edges = [(u, v, float(random.choice([1, 2, 3, 1.5]))) for u in nodes for v in nodes
             if u != v and random.random() < 0.3]
    edges.append(("n1", "n1", 2.0))
    return _graph(spark, edges, nodes) + (edges,)


def test_pagerank(rand_graph):
    nodes, v, e, edges = rand_graph
    got = {r.id: r.pr for r in C.pagerank(v, e).collect()}
    ref = R.pagerank(nodes, edges, iters=200)
    assert all(R.isclose(got[k], ref[k]) for k in nodes)
    assert abs(sum(got.values()) - 1) < 1e-9


def test_closeness_betweenness_clustering(rand_graph):
    nodes, v, e, edges = rand_graph
    cl = {r.id: r.closeness for r in C.closeness_centrality(v, e).collect()}
    bc = {r.id: r.betweenness for r in C.betweenness_centrality(v, e, batch=4).collect()}
    cc = {r.id: r.clustering for r in T.clustering(v, e).collect()}
    rc, rb, rcc = R.closeness(nodes, edges), R.betweenness(nodes, edges), R.clustering(nodes, edges)
    assert all(R.isclose(cl[k], rc[k]) for k in nodes)
    assert all(R.isclose(bc[k], rb[k]) for k in nodes)
    assert all(R.isclose(cc[k], rcc[k]) for k in nodes)


CUT_FIXTURES = {
    "path4": ([("1", "2"), ("2", "3"), ("3", "4")], []),
    "cycle4": ([("1", "2"), ("2", "3"), ("3", "4"), ("4", "1")], []),
    "two_triangles": ([("1", "2"), ("2", "3"), ("1", "3"), ("4", "5"), ("5", "6"), ("4", "6"), ("3", "4")], []),
    "star5": ([("0", "1"), ("0", "2"), ("0", "3"), ("0", "4")], []),
    "loops": ([("1", "2")], [("1", "1", 1.0)]),
    "disconnected": ([("1", "2"), ("2", "3"), ("7", "8")], []),
}


def test_cuts(spark):
    """All fixtures and sparse random graphs, as components of one graph."""
    graphs = {k: _undirected(pairs) + extra for k, (pairs, extra) in CUT_FIXTURES.items()}
    for seed in (1, 2, 3):
        rng = random.Random(seed)
        nodes = [f"v{i:02d}" for i in range(40)]
        graphs[f"random{seed}"] = [(a, b, 1.0) for a, b in sorted({tuple(sorted(rng.sample(nodes, 2))) for _ in range(40)})]
    named = {k: [(f"{k}-{a}", f"{k}-{b}", w) for a, b, w in e] for k, e in graphs.items()}
    _, v, e = _graph(spark, [x for own in named.values() for x in own] + [("lonely", "lonely", 1.0)])
    aps, br = X.critical_infrastructure(v, e)
    aps, br = {r.id for r in aps.collect()}, {(r.a, r.b) for r in br.collect()}
    for k, own in named.items():
        nodes = sorted({x for a, b, _ in own for x in (a, b)})
        assert {x for x in aps if x.startswith(k + "-")} == R.articulation_points(nodes, own), k
        assert {x for x in br if x[0].startswith(k + "-")} == R.bridges(nodes, own), k
    assert "lonely" not in aps


def test_communities_two_triangles(spark):
    pairs = [("1", "2"), ("2", "3"), ("1", "3"), ("4", "5"), ("5", "6"), ("4", "6"), ("3", "4")]
    edges = _undirected(pairs)
    nodes, v, e = _graph(spark, edges)
    memb = {r.id: r.community for r in CM.communities(v, e).collect()}
    assert set(memb) == set(nodes)
    assert R.modularity(edges, memb) >= R.modularity(edges, {n: n for n in nodes})


def test_walks_stop_at_sink(spark):
    nodes, v, e = _graph(spark, [("1", "2", 1.0)])
    visits = {(r.start, r.node): r.visits for r in W.random_walk_visits(v, e, num_walks=5, walk_length=3).collect()}
    assert visits == {("1", "2"): 5}


def test_components_of_a_long_path_and_a_star(spark):
    from lanegraph.operators.graph.core import connected_components
    path = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(64)]
    star = [("h000", f"h{i:03d}") for i in range(1, 80)]
    und = spark.createDataFrame(path + star, "a string, b string")
    ids = spark.createDataFrame([(x,) for x in sorted({x for e in path + star for x in e} | {"lonely"})], "id string")
    got = {r.id: r.component for r in connected_components(ids, und).collect()}
    assert all(got[x] == ("p000" if x[0] == "p" else "h000") for x in got if x != "lonely") and got["lonely"] == "lonely"


def test_sorted_index_is_contiguous(spark):
    from pyspark.sql import functions as F
    from lanegraph.operators.graph.core import sorted_index
    df = spark.range(1000).select(F.concat(F.lit("k"), F.pmod(F.col("id") * 37, F.lit(1000)).cast("string")).alias("k")).repartition(5)
    got = sorted_index(df, [F.col("k")], "i").orderBy("i").collect()
    assert [r.i for r in got] == list(range(1000)) and [r.k for r in got] == sorted(r.k for r in got)


def test_walk_intervals_touch_and_walkers_stay(spark):
    random.seed(3)
    edges = [(f"a{i}", f"a{random.randrange(12)}", random.random() + 0.01) for i in range(12) for _ in range(9)]
    edges = list({(a, b): (a, b, w) for a, b, w in edges}.values())
    _, v, e = _graph(spark, edges)
    rows = W.transition_slots(e).select("src", "dst", "lo", "hi").distinct().orderBy("src", "lo").collect()
    for src in {r.src for r in rows}:
        own = [r for r in rows if r.src == src]
        assert own[0].lo == 0.0 and own[-1].hi >= 1.0 and all(x.hi == y.lo for x, y in zip(own, own[1:]))
    visits = W.random_walk_visits(v, e, num_walks=200, walk_length=4)
    per_start = {r.start: r.n for r in visits.groupBy("start").agg({"visits": "sum"}).toDF("start", "n").collect()}
    assert set(per_start.values()) == {800}                 # every vertex has a way out: no walker is lost or doubled
    seen = {(r.start, r.node): r.visits for r in visits.collect()}
    want = {(r.start, r.node): r.expected for r in W.expected_visits(v, e, walk_length=4, num_walks=200).collect()}
    assert abs(sum(want.values()) - 800 * 12) < 1e-6
    assert max(abs(seen.get(k, 0) - x) for k, x in want.items()) < 90


def test_communities_reach_a_local_optimum(spark):
    """Rings of cliques: every clique is found, whatever the order of moves."""
    pairs = []
    for c in range(6):
        own = [f"c{c}n{i}" for i in range(5)]
        pairs += [(a, b) for a in own for b in own if a < b] + [(own[0], f"c{(c + 1) % 6}n1")]
    _, v, e = _graph(spark, _undirected(pairs))
    got = {r.id: r.community for r in CM.communities(v, e).collect()}
    assert len(set(got.values())) == 6 and all(len({got[x] for x in got if x.startswith(f"c{c}")}) == 1 for c in range(6))


def test_cuts_of_a_long_path_and_of_no_edges(spark):
    """10,000 vertices in a row and a ring: rounds by the logarithm, rows linear."""
    n = 10_000
    path = spark.range(n - 1).selectExpr("format_string('p%05d', id) src", "format_string('p%05d', id + 1) dst", "1.0D weight")
    ring = spark.range(50).selectExpr("format_string('r%02d', id) src", "format_string('r%02d', (id + 1) % 50) dst", "1.0D weight")
    e = path.union(ring)
    v = e.selectExpr("src id").union(e.selectExpr("dst id")).distinct()
    aps, br = X.critical_infrastructure(v, e)
    assert br.count() == n - 1 and aps.count() == n - 2
    assert aps.where("id in ('p00000', 'p09999') or id like 'r%'").isEmpty() and br.where("a like 'r%'").isEmpty()
    aps, br = X.critical_infrastructure(v, e.limit(0))
    assert aps.isEmpty() and br.isEmpty()


def test_second_order_transitions(spark):
    """Shares of the next vertex, given (previous, current), against p, q and the weights."""
    from pyspark.sql import functions as F
    edges = [("t", "v", 1.0), ("v", "t", 2.0), ("v", "x", 1.0), ("v", "y", 3.0), ("v", "v", 1.0), ("t", "x", 1.0), ("x", "t", 1.0), ("y", "v", 1.0)]
    _, _, e = _graph(spark, edges)
    slots, links, p, q, n = W.transition_slots(e), W.edge_links(e), 4.0, 0.25, 40_000
    walkers = spark.range(n).select(F.lit("t").alias("start"), F.col("id").cast("int").alias("walk"), F.lit("t").alias("prev"), F.lit("v").alias("cur"))
    parts = W.second_order_step(walkers, slots, links, p, q, 42, 2)
    got = {}
    for part in parts:
        for r in part.groupBy("prev", "cur").count().collect():
            assert r.prev == "v"
            got[r.cur] = got.get(r.cur, 0) + r["count"]
    raw = {"t": 2.0 / p, "x": 1.0, "y": 3.0 / q, "v": 1.0}      # t itself, two neighbours of t, one apart from it
    total = sum(raw.values())
    assert sum(got.values()) == n
    for k, w in raw.items():
        share = w / total
        assert abs(got.get(k, 0) / n - share) < 5 * (share * (1 - share) / n) ** 0.5, k


def test_second_order_walks_of_p_q_one_are_first_order(spark):
    _, v, e = _graph(spark, [("a", "b", 1.0), ("b", "a", 2.0), ("b", "c", 1.0), ("c", "b", 1.0), ("c", "d", 1.0), ("a", "c", 0.5)])
    first = sorted(map(tuple, W.random_walk_visits(v, e, 30, 3).collect()))
    assert first == sorted(map(tuple, W.second_order_visits(v, e, 30, 3, p=1.0, q=1.0).collect()))
    away = W.random_walk_visits(v, e, 30, 3, p=1.0, q=2.0)
    assert away.agg({"visits": "sum"}).first()[0] <= 4 * 30 * 3 and away.where("start = 'd'").isEmpty()
    with pytest.raises(ValueError):
        W.random_walk_visits(v, e, 3, 2, p=0.0)


def test_betweenness_from_sampled_sources(spark, rand_graph):
    rng = random.Random(11)
    names = [f"s{i:03d}" for i in range(240)]
    edges = [(u, v, float(rng.choice([1, 2, 3]))) for u in names for v in rng.sample(names, 3) if u != v]
    _, v, e = _graph(spark, edges, names)
    exact = R.betweenness(names, edges)
    got = {r.id: r for r in C.sampled_betweenness(v, e, eps=0.5, first=128).collect()}
    assert set(got) == set(names) and {r.sources for r in got.values()} == {128}
    assert all(0 < r.bound <= 0.5 and abs(r.betweenness - exact[k]) <= r.bound for k, r in got.items())
    assert sum(abs(r.betweenness - exact[k]) for k, r in got.items()) < 0.5 * sum(exact.values())
    nodes, v, e, edges = rand_graph                       # a bound of 0 takes every source
    exact = R.betweenness(nodes, edges)
    for r in C.sampled_betweenness(v, e, eps=0.0, first=4, batch=3).collect():
        assert (r.bound, r.sources) == (0.0, 10) and R.isclose(r.betweenness, exact[r.id])


def test_hyperball_against_exact_distances(spark, rand_graph):
    nodes, v, e, edges = rand_graph
    exact = R.closeness(nodes, edges)
    got = {r.id: r for r in C.hyperball(v, e, p=12).collect()}
    assert set(got) == set(exact)
    for i, c in exact.items():
        assert got[i].closeness == pytest.approx(c, rel=3 * 1.04 / 64, abs=1e-9)
    # a hub that thousands reach: the bound holds where no register is empty
    leaves = 20_000
    v = spark.range(leaves + 1).select("id")
    e = spark.range(1, leaves + 1).selectExpr("id AS src", "0L AS dst", "1.0D AS weight")
    star = {r.id: r for r in C.hyperball(v, e, p=8).where("id < 2").collect()}
    assert star[0].reach == pytest.approx(leaves + 1, rel=3 * 1.04 / 16)
    assert star[0].harmonic == pytest.approx(leaves, rel=3 * 1.04 / 16)
    assert star[1].closeness == 0 and star[1].reach == pytest.approx(1)


def test_hyperball_without_edges_or_vertices(spark):
    v = spark.createDataFrame([("a",), ("b",)], "id string")
    e = spark.createDataFrame([("a", "a", 1.0)], "src string, dst string, weight double")
    assert {r.id: (r.closeness, r.harmonic) for r in C.hyperball(v, e).collect()} == {"a": (0, 0), "b": (0, 0)}
    assert C.hyperball(v.limit(0), e.limit(0)).count() == 0


def test_greedy_communities(spark, rand_graph):
    from lanegraph.operators.graph import core as G
    nodes, v, e, edges = rand_graph

    def parts_of(v, e):
        und = [(r.a, r.b) for r in G.undirected_simple(e).collect()]
        memb = {r.id: r.community for r in CM.greedy_communities(v, e).collect()}
        comp = R._components(list(memb), [(a, b) for a, b in und if memb[a] == memb[b]])
        assert comp == len(set(memb.values()))            # every community is connected
        return memb

    memb = parts_of(v, e)
    assert set(memb) == set(nodes)
    whole, rounds = CM.merge_rounds(v.select("id"), G.undirected_simple(e, "weight"))
    merged = {r.id: r.community for r in whole.collect()}
    assert R.modularity(edges, memb) >= R.modularity(edges, merged) - 1e-12
    for a in set(merged.values()):                             # no two merged communities gain by joining
        for b in set(merged.values()):
            joined = {i: a if c == b else c for i, c in merged.items()}
            assert R.modularity(edges, joined) <= R.modularity(edges, merged) + 1e-9
    # rings of 6 on a ring: the rings are found, in few rounds
    rings = [(f"{g:02}{i}", f"{g:02}{(i + 1) % 6}", 5.0) for g in range(24) for i in range(6)]
    rings += [(f"{g:02}0", f"{(g + 1) % 24:02}3", 0.1) for g in range(24)]
    rv = spark.createDataFrame(sorted({(x,) for a, b, _ in rings for x in (a, b)}), "id string")
    re = spark.createDataFrame(rings, "src string, dst string, weight double")
    found = parts_of(rv, re)
    assert all(len({found[f"{g:02}{i}"] for i in range(6)}) == 1 for g in range(24))
    _, rounds = CM.merge_rounds(rv.select("id"), G.undirected_simple(re, "weight"))
    assert rounds <= 16
    lone = spark.createDataFrame([("a",), ("b",)], "id string")
    assert CM.greedy_communities(lone, re.limit(0)).count() == 2
