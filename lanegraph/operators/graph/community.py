"""Modularity communities by distributed local moving (Louvain-style).

The graph is made undirected; reciprocal corridors add their weights and
self-loops are dropped.  Every vertex scores the communities of its neighbours
with the standard modularity gain; levels of local moving and merging run to
convergence.  Community ids are ranked by size (desc), then smallest member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..aggregate import one_row_join
from .core import both_directions, connected_components, cut, discard, sorted_index, undirected_simple


def modularity(und_w: DataFrame, membership: DataFrame) -> DataFrame:
    """Q = Σ_c [L_c/m − (D_c/2m)²] as a one-row frame (column ``modularity``)."""
    m = und_w.agg(F.sum("w").alias("_m"))
    ma = membership.select(F.col("id").alias("a"), F.col("community").alias("ca"))
    mb = membership.select(F.col("id").alias("b"), F.col("community").alias("cb"))
    e = und_w.join(ma, "a").join(mb, "b")
    inside = e.where(F.col("ca") == F.col("cb")).groupBy(F.col("ca").alias("community")).agg(F.sum("w").alias("_l"))
    deg = both_directions(und_w, ["w"]).groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("_k"))
    tot = deg.join(membership, "id").groupBy("community").agg(F.sum("_k").alias("_d"))
    per = one_row_join(tot.join(inside, "community", "left"), m)
    return per.agg(F.coalesce(F.sum(F.coalesce(F.col("_l"), F.lit(0.0)) / F.col("_m")
                                    - F.pow(F.col("_d") / (2 * F.col("_m")), 2)), F.lit(0.0)).alias("modularity"))


def _links(adj: DataFrame, memb: DataFrame) -> DataFrame:
    """(u, c, k_in): weight from u into each neighbouring community."""
    return (adj.where(F.col("u") != F.col("v")).join(memb.select(F.col("id").alias("v"), F.col("community").alias("c")), "v")
            .groupBy("u", "c").agg(F.sum("w").alias("k_in")))


def _quality(adj: DataFrame, k: DataFrame, memb: DataFrame, m2: float) -> float:
    """Q of a membership; self-loops hold the inner weight of merged vertices."""
    own = memb.select(F.col("id").alias("u"), F.col("community").alias("cu"))
    other = memb.select(F.col("id").alias("v"), F.col("community").alias("cv"))
    inside = adj.join(own, "u").join(other, "v").where("cu = cv").agg(F.sum("w")).first()[0] or 0.0
    tot = k.join(memb, "id").groupBy("community").agg(F.sum("k").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).first()[0] or 0.0
    return inside / m2 - tot / (m2 * m2)


def _local_moving(ids: DataFrame, adj: DataFrame, m2: float, start: DataFrame | None = None) -> DataFrame:
    """From ``start`` (each vertex alone by default) move vertices to the neighbouring community of highest gain until no
    vertex gains.  A round moves a hashed share of the vertices that gain; a
    round that doesn't raise Q is undone and the share halved, down to the one
    best vertex, whose move always raises Q.  So Q rises strictly and the loop
    ends."""
    k = cut(adj.groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("k")))
    memb = cut(ids.select("id", F.col("id").alias("community")) if start is None else start)
    q, share, rnd = _quality(adj, k, memb, m2), 2, 0
    while True:
        rnd += 1
        tot = memb.join(k, "id").groupBy("community").agg(F.sum("k").alias("tot"))
        me = memb.select(F.col("id").alias("u"), F.col("community").alias("own")).join(k.select(F.col("id").alias("u"), "k"), "u")
        # a vertex may always stay where it is, even without a neighbour there
        links = _links(adj, memb).unionByName(me.select("u", F.col("own").alias("c"), F.lit(0.0).alias("k_in")))
        links = links.groupBy("u", "c").agg(F.sum("k_in").alias("k_in"))
        cand = links.join(me, "u").join(tot.select(F.col("community").alias("c"), "tot"), "c")
        rest = F.when(F.col("c") == F.col("own"), F.col("tot") - F.col("k")).otherwise(F.col("tot"))
        cand = cand.withColumn("gain", F.col("k_in") - rest * F.col("k") / F.lit(m2))
        best = cand.groupBy("u").agg(F.max_by(F.struct("c", "gain"), F.struct("gain", "c")).alias("b"),
                                     F.max(F.when(F.col("c") == F.col("own"), F.col("gain"))).alias("stay"), F.first("own").alias("own"))
        moves = cut(best.where((F.col("b.c") != F.col("own")) & (F.col("b.gain") > F.col("stay") + 1e-9 * m2))
                    .select(F.col("u").alias("id"), F.col("b.c").alias("_new"), (F.col("b.gain") - F.col("stay")).alias("up")))
        left = moves.count()
        if left == 0:
            discard(moves)
            return memb
        while True:
            chosen = moves.where(F.pmod(F.xxhash64("id", F.lit(rnd)), F.lit(share)) == 0) if share < 2 * left else \
                moves.orderBy(F.desc("up"), "id").limit(1)
            tried = cut(memb.join(chosen.select("id", "_new"), "id", "left").select("id", F.coalesce("_new", "community").alias("community")))
            q2 = _quality(adj, k, tried, m2)
            if q2 > q + 1e-12:
                discard(memb)
                memb, q, share = tried, q2, max(2, share // 2)
                break
            discard(tried)
            if share >= 2 * left:
                return memb
            share *= 2
        discard(moves)


def communities(vertices: DataFrame, edges: DataFrame, weight: str = "weight") -> DataFrame:
    """(id, community) with ids 0.. by community size.

    Levels of local moving; after each one communities become vertices (their
    inner weight a self-loop) and moving starts again, until a level changes
    nothing."""
    und = cut(undirected_simple(edges, weight))
    adj = cut(both_directions(und, ["w"]))
    m2 = float(adj.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0])
    whole = cut(vertices.select("id", F.col("id").alias("community")))
    ids = vertices.select("id")
    while m2 > 0:
        memb = _local_moving(ids, adj, m2)
        if memb.where(F.col("id") != F.col("community")).isEmpty():
            break
        nxt = cut(whole.withColumnRenamed("community", "_c").join(memb.withColumnRenamed("id", "_c"), "_c").select("id", "community"))
        discard(whole)
        whole = nxt
        cu, cv = (memb.select(F.col("id").alias(x), F.col("community").alias("c" + x)) for x in ("u", "v"))
        adj = cut(adj.join(cu, "u").join(cv, "v").groupBy(F.col("cu").alias("u"), F.col("cv").alias("v")).agg(F.sum("w").alias("w")))
        ids = cut(memb.select(F.col("community").alias("id")).distinct())
    return _ranked(whole)


def _ranked(whole: DataFrame) -> DataFrame:
    sizes = whole.groupBy("community").agg(F.count("*").alias("_n"), F.min("id").alias("_first"))
    ranked = sorted_index(sizes, [F.desc("_n"), F.col("_first")], "_rank")
    return whole.join(ranked.select("community", "_rank"), "community").select("id", F.col("_rank").cast("int").alias("community"))


def merge_rounds(ids: DataFrame, und: DataFrame) -> tuple[DataFrame, int]:
    """Greedy merging of communities: ((id, community), rounds).

    The table of community pairs holds the gain of merging each pair.  In a
    round every community points to its best partner.  Mutually best pairs
    merge, the larger id into the smaller; of the others a hashed half stays
    and the rest may join a partner that stays.  Those that join one partner
    are taken only if their gain is still positive with all others counted as
    joined before them, so Q rises with every merge; where none passes, the
    mutually best pair merges alone.  The best pair of all is mutual, so each
    round merges something, usually a fixed share of the communities, and the
    loop ends when no pair gains.  Merges follow edges: communities are
    connected.
    """
    whole = cut(ids.select("id", F.col("id").alias("community")))
    pairs = cut(und.select("a", "b", "w"))
    deg = cut(both_directions(pairs, ["w"]).groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("k")))
    m2 = float(deg.agg(F.coalesce(F.sum("k"), F.lit(0.0))).first()[0])
    rounds = 0
    while m2 > 0:
        ka, kb = (deg.select(F.col("id").alias(x), F.col("k").alias("k" + x)) for x in ("a", "b"))
        gains = (pairs.join(ka, "a").join(kb, "b").withColumn("gain", F.col("w") / m2 - F.col("ka") * F.col("kb") / (m2 * m2))
                 .where(F.col("gain") > 1e-15))
        ends = gains.select("a", "b", "gain", "w", F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v"), F.col("ka").alias("ku"), F.col("kb").alias("kv")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v"), F.col("kb").alias("ku"), F.col("ka").alias("kv")))).alias("e"))
        best = cut(ends.groupBy("e.u").agg(F.max_by(F.struct("e.v", "w", "e.ku", "e.kv"), F.struct("gain", "a", "b")).alias("x"))
                   .select("u", "x.*"))
        if best.isEmpty():
            discard(best)
            break
        rounds += 1
        back = best.select(F.col("u").alias("v"), F.col("v").alias("_back"))
        roles = cut(best.join(back, "v").withColumn("mutual", F.col("_back") == F.col("u"))
                    .withColumn("stays", F.when(F.col("mutual"), F.col("u") < F.col("v"))
                                .otherwise(F.pmod(F.xxhash64("u", F.lit(rounds)), F.lit(2)) == 0)).drop("_back"))
        join = roles.where(~F.col("stays")).join(roles.where("stays").select(F.col("u").alias("v")), "v", "left_semi")
        rest = join.groupBy("v").agg(F.sum("ku").alias("_all"))
        join = join.join(rest, "v").withColumn("ok", F.col("w") / m2 - F.col("ku") * (F.col("kv") + F.col("_all") - F.col("ku")) / (m2 * m2) > 0)
        some = join.groupBy("v").agg(F.max("ok").alias("_some"))
        merges = cut(join.join(some, "v").where(F.col("ok") | (~F.col("_some") & F.col("mutual"))).select(F.col("u").alias("_old"), F.col("v").alias("_new")))

        def renamed(df, col):
            return df.withColumnRenamed(col, "_old").join(merges, "_old", "left").withColumn(col, F.coalesce("_new", "_old")).drop("_old", "_new")

        old = (whole, pairs, deg, best, roles)
        whole = cut(renamed(whole, "community").select("id", "community"))
        moved = renamed(renamed(pairs, "a"), "b").where(F.col("a") != F.col("b"))
        pairs = cut(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("w").alias("w")))
        deg = cut(renamed(deg, "id").groupBy("id").agg(F.sum("k").alias("k")))
        discard(*old, merges)
    discard(pairs, deg)
    return whole, rounds


def greedy_communities(vertices: DataFrame, edges: DataFrame, weight: str = "weight", refine: bool = True) -> DataFrame:
    """(id, community) by greedy modularity merging, ids 0.. by community size.

    ``refine``: merged communities are refined by vertex moves that raise Q,
    then split into their connected parts, which never lowers Q."""
    und = cut(undirected_simple(edges, weight))
    adj = cut(both_directions(und, ["w"]))
    m2 = float(adj.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0])
    ids = vertices.select("id")
    whole, _ = merge_rounds(ids, und)
    if refine and m2 > 0:
        whole = _local_moving(ids, adj, m2, whole)
        ca, cb = (whole.select(F.col("id").alias(x), F.col("community").alias("c" + x)) for x in ("a", "b"))
        inner = und.join(ca, "a").join(cb, "b").where("ca = cb").select("a", "b")
        whole = cut(connected_components(ids, inner).withColumnRenamed("component", "community"))
    return _ranked(whole)
