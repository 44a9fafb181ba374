"""Degree, PageRank, closeness and weighted betweenness as DataFrame rounds.

Path-based measures keep one row per (source, vertex) pair.  ``batch``
splits the sources into groups processed one after another, which bounds
the working set to batch × |V| rows for large graphs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..aggregate import one_row_join
from .core import cut, discard, sorted_index


def degree_centrality(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(in+out)/(n−1), in/(n−1), out/(n−1); a self-loop counts in both."""
    n = vertices.agg(F.count("*").alias("_n"))
    outd = edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_deg"))
    ind = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_deg"))
    d = (vertices.select("id").join(outd, "id", "left").join(ind, "id", "left")
         .fillna(0, ["out_deg", "in_deg"]))
    s = F.when(F.col("_n") > 1, F.lit(1.0) / (F.col("_n") - 1)).otherwise(F.lit(1.0))
    return (one_row_join(d, n)
            .select("id", "in_deg", "out_deg",
                    ((F.col("in_deg") + F.col("out_deg")) * s).alias("degree_centrality"),
                    (F.col("in_deg") * s).alias("in_degree_centrality"),
                    (F.col("out_deg") * s).alias("out_degree_centrality")))


def pagerank(vertices: DataFrame, edges: DataFrame, alpha: float = 0.85, tolerance: float = 1e-10,
             weight: str = "weight") -> DataFrame:
    """Weighted PageRank, uniform teleport, dangling mass spread uniformly.

    With uniform teleport and uniform dangling redistribution the stationary
    vector is proportional to the solution of y = b + α·Pᵀy (b = (1−α)/n).
    One join and one partial aggregate per round on the stochastic edges, until
    the L1 change falls to ``tolerance``; the change shrinks by α or more each
    round, so the loop ends.
    """
    n = vertices.count()
    outw = edges.groupBy("src").agg(F.sum(weight).alias("_wsum"))
    q = cut(edges.join(outw, "src").where(F.col("_wsum") > 0).select("dst", "src", (alpha * F.col(weight) / F.col("_wsum")).alias("q")))
    y = cut(vertices.select("id", F.lit(1.0 / max(n, 1)).alias("y")))
    while True:
        moved = y.join(q, y.id == q.src).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("y") * F.col("q")).alias("_in"))
        nxt = cut(y.join(moved, "id", "left").select("id", F.col("y").alias("old"), (F.lit((1.0 - alpha) / max(n, 1))
                                                                                  + F.coalesce("_in", F.lit(0.0))).alias("y")))
        change = nxt.agg(F.sum(F.abs(F.col("y") - F.col("old")))).first()[0] or 0.0
        discard(y)
        y = nxt.select("id", "y")
        y._scratch_path = nxt._scratch_path
        if change <= tolerance:
            break
    total = y.agg(F.sum("y").alias("_s"))
    return one_row_join(y, total).select("id", (F.col("y") / F.col("_s")).alias("pr"))


SOURCE_BATCH = 256


def _batches(ids: DataFrame, batch: int | None):
    if not batch:
        return [ids]
    nb = max(1, -(-ids.count() // batch))
    keyed = ids.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(nb)))
    return [keyed.where(F.col("_b") == i).drop("_b") for i in range(nb)]


def hop_distances(vertices: DataFrame, edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Unweighted BFS from every source: rows ``(s, v, d)`` for reachable v."""
    e = edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()
    src = sources if sources is not None else vertices.select("id")
    dist = cut(src.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0).alias("d")))
    frontier = dist
    level = 0
    while True:
        level += 1
        cand = (frontier.join(e, frontier.v == e.src).select("s", F.col("dst").alias("v")).distinct()
                .join(dist, ["s", "v"], "left_anti").withColumn("d", F.lit(level)))
        cand = cut(cand)
        if cand.isEmpty():
            return dist
        grown = cut(dist.unionByName(cand))
        discard(dist, frontier)
        dist, frontier = grown, cand


def closeness_centrality(vertices: DataFrame, edges: DataFrame, batch: int | None = SOURCE_BATCH) -> DataFrame:
    """Closeness on incoming hop distances, scaled by the reachable share
    (Wasserman–Faust): (r−1)/Σd · (r−1)/(n−1)."""
    n = vertices.count()
    parts = []
    for b in _batches(vertices.select("id"), batch):
        dist = hop_distances(vertices, edges, b)
        parts.append(cut(dist.groupBy(F.col("v").alias("id")).agg(F.count("*").alias("_r"), F.sum("d").alias("_tot"))))
        discard(dist)
    agg = parts[0]
    for p in parts[1:]:
        agg = agg.unionByName(p)
    agg = agg.groupBy("id").agg(F.sum("_r").alias("_r"), F.sum("_tot").alias("_tot"))
    c = F.when((F.col("_tot") > 0) & F.lit(n > 1),
               (F.col("_r") - 1) / F.col("_tot") * ((F.col("_r") - 1) / F.lit(max(n - 1, 1))))
    return (vertices.select("id").join(agg, "id", "left")
            .select("id", F.coalesce(c, F.lit(0.0)).alias("closeness")))


def _ball_sizes(registers: DataFrame, p: int) -> DataFrame:
    """(id, size): distinct vertices behind the registers of every id; linear
    counting while registers are empty and the raw estimate is small."""
    m = 1 << p
    alpha = {4: 0.673, 5: 0.697, 6: 0.709}.get(p, 0.7213 / (1 + 1.079 / m))
    z = registers.groupBy("id").agg(F.count("*").alias("_used"), F.sum(F.pow(F.lit(2.0), -F.col("rho"))).alias("_z"))
    free = F.lit(m) - F.col("_used")
    raw = F.lit(alpha * m * m) / (F.col("_z") + free)
    return z.select("id", F.when((raw <= 2.5 * m) & (free > 0), F.lit(float(m)) * F.log(F.lit(float(m)) / free)).otherwise(raw).alias("size"))


def hyperball(vertices: DataFrame, edges: DataFrame, p: int = 10) -> DataFrame:
    """(id, reach, closeness, harmonic) from sketches of the incoming balls.

    For graphs whose |V|² distances cannot be held.  The ball of radius t
    around a vertex is kept as HyperLogLog registers, one row per (vertex,
    register), 2^p of them at most.  A round sends only the registers raised
    in the round before along the edges and keeps the larger value; partial
    aggregates cut what a hub receives.  Σd adds t times the growth of the
    ball in round t, the harmonic sum its t-th part.  ``reach`` has a relative
    standard error of about 1.04 / 2^(p/2), whatever the size (less for small
    balls), the harmonic sum at most about the same; closeness goes with the
    square of the reach and errs up to twice as much.  It is scaled as in
    ``closeness_centrality``.  Rounds
    end with the longest shortest path; ids are taken as distinct.
    """
    m, n = 1 << p, vertices.count()
    e = cut(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct())
    h = F.xxhash64("id")
    rest = F.shiftrightunsigned(h, p)
    rho = F.lit(65 - p) - F.when(rest == 0, 0).otherwise(F.length(F.bin(rest)))
    regs = cut(vertices.select("id", h.bitwiseAND(F.lit(m - 1)).cast("int").alias("reg"), rho.cast("int").alias("rho")))
    one = m * math.log(m / (m - 1))
    ball = cut(vertices.select("id", F.lit(one).alias("size"), F.lit(0.0).alias("tot"), F.lit(0.0).alias("harmonic")))
    raised, t = regs, 0
    while True:
        t += 1
        got = raised.join(e, raised.id == e.src).groupBy(F.col("dst").alias("id"), "reg").agg(F.max("rho").alias("rho"))
        up = cut(got.join(regs.withColumnRenamed("rho", "_old"), ["id", "reg"], "left")
                 .where(F.col("_old").isNull() | (F.col("rho") > F.col("_old"))).drop("_old"))
        if up.isEmpty():
            discard(up)
            break
        grown = cut(regs.unionByName(up).groupBy("id", "reg").agg(F.max("rho").alias("rho")))
        now = _ball_sizes(grown.join(up.select("id").distinct(), "id", "left_semi"), p).withColumnRenamed("size", "_now")
        more = F.greatest(F.coalesce("_now", "size") - F.col("size"), F.lit(0.0))
        nxt = cut(ball.join(now, "id", "left").select("id", (F.col("size") + more).alias("size"), (F.col("tot") + t * more).alias("tot"),
                                                      (F.col("harmonic") + more / t).alias("harmonic")))
        discard(regs, raised, ball)
        regs, raised, ball = grown, up, nxt
    r = F.col("size") - one
    c = F.when((F.col("tot") > 0) & F.lit(n > 1), r / F.col("tot") * (r / F.lit(max(n - 1, 1)))).otherwise(F.lit(0.0))
    return ball.select("id", (r + 1).alias("reach"), c.alias("closeness"), "harmonic")


def weighted_distances(edges: DataFrame, sources: DataFrame, weight: str = "weight") -> DataFrame:
    """Shortest weighted distances (Bellman–Ford from a frontier of improved pairs).

    Distances are sums along the path in path order, like Dijkstra's.
    """
    e = edges.select("src", "dst", F.col(weight).alias("w"))
    dist = cut(sources.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0.0).alias("d")))
    frontier = dist
    while True:
        cand = (frontier.join(e, frontier.v == e.src)
                .select("s", F.col("dst").alias("v"), (F.col("d") + F.col("w")).alias("nd"))
                .groupBy("s", "v").agg(F.min("nd").alias("nd")))
        improved = (cand.join(dist, ["s", "v"], "left")
                    .where(F.col("d").isNull() | (F.col("nd") < F.col("d")))
                    .select("s", "v", F.col("nd").alias("d")))
        improved = cut(improved)
        if improved.isEmpty():
            return dist
        grown = cut(dist.join(improved.select("s", "v"), ["s", "v"], "left_anti").unionByName(improved))
        discard(dist, frontier)
        dist, frontier = grown, improved


def _dependencies(edges: DataFrame, sources: DataFrame, weight: str) -> DataFrame:
    """``(s, id, delta)``: dependency of every source on the vertices inside its shortest paths."""
    e = edges.where(F.col("src") != F.col("dst")).select("src", "dst", F.col(weight).alias("w"))
    dist = weighted_distances(edges.where(F.col("src") != F.col("dst")), sources, weight)
    du = dist.select("s", F.col("v").alias("u"), F.col("d").alias("du"))
    dv = dist.select("s", F.col("v").alias("v"), F.col("d").alias("dv"))
    # shortest-path DAG per source: u -> v when d(s,u) + w(u,v) == d(s,v) (exact, as Dijkstra compares)
    dag = cut(du.join(e, du.u == e.src).select("s", "u", F.col("dst").alias("v"), "du", "w")
              .join(dv, ["s", "v"])
              .where(((F.col("du") + F.col("w")) == F.col("dv")) & (F.col("v") != F.col("s")))
              .select("s", "u", "v"))
    # forward: number of shortest paths, layered by hop count
    layer = sources.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(1.0).alias("c"))
    sigma = layer
    while True:
        layer = cut(layer.withColumnRenamed("v", "u").join(dag, ["s", "u"])
                    .groupBy("s", "v").agg(F.sum("c").alias("c")))
        if layer.isEmpty():
            break
        sigma = sigma.unionByName(layer)
    sigma = cut(sigma.groupBy("s", "v").agg(F.sum("c").alias("sigma")))
    # backward: x(s,v) = sum over DAG paths leaving v of 1/sigma(s, end)
    inv = sigma.select("s", F.col("v").alias("w"), (F.lit(1.0) / F.col("sigma")).alias("y"))
    child = dag.select("s", F.col("u").alias("v"), F.col("v").alias("w"))
    layer = inv
    xs = None
    while True:
        layer = cut(layer.join(child, ["s", "w"]).groupBy("s", "v").agg(F.sum("y").alias("y"))
                    .withColumnRenamed("v", "w"))
        if layer.isEmpty():
            break
        xs = layer if xs is None else xs.unionByName(layer)
    if xs is None:
        return sources.select(F.col("id").alias("s"), "id", F.lit(0.0).alias("delta")).limit(0)
    x = xs.groupBy("s", F.col("w").alias("v")).agg(F.sum("y").alias("x"))
    return (x.join(sigma, ["s", "v"]).where(F.col("s") != F.col("v"))
            .select("s", F.col("v").alias("id"), (F.col("sigma") * F.col("x")).alias("delta")))


def betweenness_centrality(vertices: DataFrame, edges: DataFrame, weight: str = "weight",
                           batch: int | None = SOURCE_BATCH, normalized: bool = True) -> DataFrame:
    """Exact Brandes betweenness on weighted directed shortest paths."""
    n = vertices.count()
    parts = [cut(_dependencies(edges, b, weight).groupBy("id").agg(F.sum("delta").alias("bc"))) for b in _batches(vertices.select("id"), batch)]
    bc = parts[0]
    for p in parts[1:]:
        bc = bc.unionByName(p)
    bc = bc.groupBy("id").agg(F.sum("bc").alias("bc"))
    scale = 1.0 / ((n - 1) * (n - 2)) if normalized and n > 2 else 1.0
    return (vertices.select("id").join(bc, "id", "left")
            .select("id", (F.coalesce(F.col("bc"), F.lit(0.0)) * scale).alias("betweenness")))


def sampled_betweenness(vertices: DataFrame, edges: DataFrame, eps: float, delta: float = 0.1, weight: str = "weight",
                        first: int = SOURCE_BATCH, batch: int = SOURCE_BATCH, seed: int = 42) -> DataFrame:
    """``(id, betweenness, bound, sources)``: normalised betweenness from sampled
    sources, off by at most ``bound`` ≤ ``eps`` for all vertices at once with
    probability 1 − ``delta``.

    Sources are taken in a seeded random order without replacement, ``first`` at
    first, then twice as many each time, until the largest empirical
    Bernstein–Serfling bound is at most ``eps``.  The error probability is shared
    between both sides, the vertices and the looks at the bound.  A graph too
    small for ``eps`` has all its sources used: exact, with a bound of 0.  What
    is kept between rounds is a sum and a sum of squares per vertex.
    """
    n = vertices.count()
    if n <= 2:
        return vertices.select("id", F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("bound"), F.lit(n).cast("long").alias("sources"))
    order = cut(sorted_index(vertices.select("id"), [F.xxhash64(F.lit(seed), "id"), F.col("id")], "_k"))
    scale, widest, kappa = n / ((n - 1) * (n - 2)), n / (n - 1), 7 / 3 + 3 / math.sqrt(2)
    sums, m, looks = None, 0, 0
    while True:
        upto, looks = min(n, max(first, 2 * m)), looks + 1
        for lo in range(m, upto, batch):
            own = order.where((F.col("_k") >= lo) & (F.col("_k") < min(lo + batch, upto))).select("id")
            part = _dependencies(edges, own, weight).groupBy("id").agg(F.sum("delta").alias("s1"), F.sum(F.col("delta") * F.col("delta")).alias("s2"))
            if sums is not None:
                part = part.unionByName(sums).groupBy("id").agg(F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
            new = cut(part)
            if sums is not None:
                discard(sums)
            sums = new
        m = upto
        mean = F.coalesce("s1", F.lit(0.0)) * (scale / m)
        deviation = F.sqrt(F.greatest(F.coalesce("s2", F.lit(0.0)) * (scale * scale / m) - mean * mean, F.lit(0.0)))
        rest = 1 - (m - 1) / n if 2 * m <= n else (1 - m / n) * (1 + 1 / m)
        log = math.log(5 * 2 * n * 2.0 ** looks / delta)
        bound = F.lit(0.0) if m == n else deviation * math.sqrt(2 * rest * log / m) + kappa * widest * log / m
        out = (vertices.select("id").join(sums, "id", "left")
               .select("id", mean.alias("betweenness"), bound.alias("bound"), F.lit(m).cast("long").alias("sources")))
        if m == n or out.agg(F.max("bound")).first()[0] <= eps:
            return out
