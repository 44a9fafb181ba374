"""Bridges and cut vertices (Tarjan–Vishkin) from an Euler tour of a spanning forest.

No step depends on the depth of the forest, and every table has rows in
proportion to vertices or edges, however long a chain is:

1. spanning forest by Borůvka rounds: every component takes its first outgoing
   edge, the taken edges are contracted by star rounds;
2. Euler tour: both arcs of every tree edge in one global order by (src, dst);
   the arc after (u, v) is the one that follows (v, u) among the arcs of v, the
   first of v after its last.  The tours of all components form one list;
3. list ranking by pointer doubling: after k rounds an arc knows the arc 2^k
   places on, so a target is asked for once and no key is hot;
4. the arc met first leads to the child; positions give pre-order numbers and
   subtree sizes;
5. low and high of a subtree are minima and maxima of the range [pre, pre+size).
   Level k of a sparse table holds ranges of 2^k and answers the subtrees
   of 2^k to 2^(k+1)-1 vertices; a level is dropped when the next is written;
6. a tree edge (p, v) is a bridge iff no non-tree edge leaves v's subtree:
   low(v) ≥ pre(v) and high(v) < pre(v) + size(v);
7. cut vertices from the components of the auxiliary graph on tree edges: a
   vertex whose tree edges fall in two or more biconnected components.

Isolated vertices and self-loops play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import star_components
from .core import both_directions, connected_components, cut, discard, sorted_index, undirected_simple


def spanning_forest(und: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Undirected edges ``(a, b)`` → tree edges ``(a, b)`` and ``(id, component)``,
    the component being its smallest vertex."""
    numbered = sorted_index(und.select("a", "b"), [F.col("a"), F.col("b")], "e")
    live = cut(numbered.select("e", "a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")))
    comp = cut(live.select(F.col("a").alias("id")).union(live.select(F.col("b").alias("id"))).distinct()
               .select("id", F.col("id").alias("component")))
    tree = None
    while not live.isEmpty():
        ends = live.select("e", F.col("ca").alias("c")).union(live.select("e", F.col("cb").alias("c")))
        first = ends.groupBy("c").agg(F.min("e").alias("e")).select("e").distinct()
        taken = cut(live.join(first, "e", "left_semi"))
        tree = taken.select("a", "b") if tree is None else tree.unionByName(taken.select("a", "b"))
        label = cut(star_components(taken.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))

        def renamed(df: DataFrame, c: str) -> DataFrame:
            new = label.select(F.col("id").alias(c), F.col("component").alias("_new"))
            return df.join(new, c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")

        nxt = cut(renamed(renamed(live, "ca"), "cb").where("ca != cb"))
        own = cut(renamed(comp, "component").select("id", "component"))
        discard(live, comp, label)
        live, comp = nxt, own
    return (cut(tree) if tree is not None else und.select("a", "b")), comp


def list_ranks(links: DataFrame, longest: int) -> DataFrame:
    """``(i, nxt)`` (null at the end of a list) → ``(i, left)``: links from i to
    the end, of lists of at most ``longest`` places."""
    t = cut(links.select("i", "nxt", F.when(F.col("nxt").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("left")))
    for _ in range(max(longest - 1, 0).bit_length()):
        target = t.select(F.col("i").alias("nxt"), F.col("nxt").alias("_nxt"), F.col("left").alias("_left"))
        jumped = (t.where("nxt is not null").join(target, "nxt")
                  .select("i", F.col("_nxt").alias("nxt"), (F.col("left") + F.col("_left")).alias("left")))
        done = cut(t.where("nxt is null").unionByName(jumped))
        discard(t)
        t = done
    return t.select("i", "left")


def euler_tour(tree: DataFrame, comp: DataFrame) -> DataFrame:
    """Arcs ``(src, dst, pos)`` of the tours of all components, one behind the
    other in the order of their roots (the smallest vertices)."""
    arcs = cut(sorted_index(both_directions(tree).toDF("src", "dst"), [F.col("src"), F.col("dst")], "i"))
    span = cut(arcs.groupBy("src").agg(F.min("i").alias("first"), F.max("i").alias("last")))
    follow = arcs.join(span, "src").select(F.col("dst").alias("src"), F.col("src").alias("dst"),
                                           F.when(F.col("i") < F.col("last"), F.col("i") + 1).otherwise(F.col("first")).alias("nxt"))
    start = span.join(comp.where("id = component").select(F.col("id").alias("src")), "src", "left_semi")
    start = cut(sorted_index(start.select(F.col("first").alias("start")), [F.col("start")], "k"))
    chain = start.join(start.select((F.col("k") - 1).alias("k"), F.col("start").alias("then")), "k", "left").select("start", "then")
    links = (arcs.join(follow, ["src", "dst"]).join(chain, F.col("nxt") == F.col("start"), "left")
             .select("i", F.when(F.col("start").isNull(), F.col("nxt")).otherwise(F.col("then")).alias("nxt")))
    total = arcs.count()
    return arcs.join(list_ranks(links, total), "i").select("src", "dst", (F.lit(total - 1) - F.col("left")).alias("pos"))


def rooted_forest(und: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tree edges ``(a, b)`` and ``(id, parent, pre, size)`` of every vertex with
    an edge: its parent (null at a root), pre-order number and subtree size."""
    tree, comp = spanning_forest(und)
    arcs = cut(euler_tour(tree, comp))
    down = (arcs.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
            .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.min_by("src", "pos").alias("parent"), F.min_by("dst", "pos").alias("id")))
    below = down.select("id", "parent", (F.col("lo") + 1).alias("at"), ((F.col("hi") - F.col("lo") + 1) / 2).cast("long").alias("size"))
    root = (comp.groupBy(F.col("component").alias("id")).agg(F.count("*").alias("size"))
            .join(arcs.groupBy(F.col("src").alias("id")).agg(F.min("pos").alias("at")), "id")
            .select("id", F.lit(None).cast("long").alias("parent"), "at", "size"))
    return tree, cut(sorted_index(below.unionByName(root), [F.col("at")], "pre").select("id", "parent", "pre", "size"))


def range_extremes(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """Sparse table by levels: ``values`` (pre, mn, mx) for 0 … n-1, ``ranges``
    (id, pre, size) → (id, low, high) over the places [pre, pre + size)."""
    level, width, out = cut(values.select("pre", "mn", "mx")), 1, []
    longest = ranges.agg(F.max("size")).first()[0] or 0
    while width <= longest:
        ask = ranges.where((F.col("size") >= width) & (F.col("size") < 2 * width))
        ask = ask.select("id", F.explode(F.array_distinct(F.array(F.col("pre"), F.col("pre") + F.col("size") - width))).alias("pre"))
        out.append(cut(ask.join(level, "pre").groupBy("id").agg(F.min("mn").alias("low"), F.max("mx").alias("high"))))
        both = level.unionByName(level.select((F.col("pre") - width).alias("pre"), "mn", "mx").where("pre >= 0"))
        nxt = cut(both.groupBy("pre").agg(F.min("mn").alias("mn"), F.max("mx").alias("mx")))
        discard(level)
        level, width = nxt, 2 * width
    found = ranges.limit(0).select("id", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    for x in out:
        found = found.unionByName(x)
    return found


def _tree_tables(edges: DataFrame):
    """Numbers of vertices ``(name, id)``, non-tree edges and ``(id, parent, pre, size, low, high)``."""
    named = cut(undirected_simple(edges))
    ends = named.select(F.col("a").alias("name")).union(named.select(F.col("b").alias("name"))).distinct()
    number = cut(sorted_index(ends, [F.col("name")], "id"))
    a, b = (number.select(F.col("name").alias(x), F.col("id").alias(f"_{x}")) for x in "ab")
    und = cut(named.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    tree, t = rooted_forest(und)
    non_tree = cut(und.join(tree, ["a", "b"], "left_anti"))
    other = both_directions(non_tree).join(t.select(F.col("id").alias("v"), F.col("pre").alias("pv")), "v")
    near = other.groupBy(F.col("u").alias("id")).agg(F.min("pv").alias("_mn"), F.max("pv").alias("_mx"))
    values = t.join(near, "id", "left").select("pre", F.least("pre", "_mn").alias("mn"), F.greatest("pre", "_mx").alias("mx"))
    info = cut(t.join(range_extremes(values, t), "id"))
    return number, non_tree, info


def _named(df: DataFrame, number: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.join(number.select(F.col("id").alias(c), F.col("name").alias(f"_{c}")), c).withColumn(c, F.col(f"_{c}"))
    return df.select(*cols)


def _cut_edges(info: DataFrame) -> DataFrame:
    """Tree edges that no non-tree edge leaving the child's subtree replaces."""
    return (info.where(F.col("parent").isNotNull() & (F.col("low") >= F.col("pre"))
                       & (F.col("high") < F.col("pre") + F.col("size")))
            .select(F.least("parent", "id").alias("a"), F.greatest("parent", "id").alias("b")))


def bridges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Cut edges of the undirected simple graph, as ``(a, b)`` with a < b."""
    number, _, info = _tree_tables(edges)
    return _named(_cut_edges(info), number, "a", "b")


def critical_infrastructure(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articulation points ``(id)``, bridges ``(a, b)``) from one forest."""
    number, non_tree, info = _tree_tables(edges)
    br = _named(_cut_edges(info), number, "a", "b")
    # auxiliary graph: one vertex per tree edge, named by its child endpoint
    nodes = info.where(F.col("parent").isNotNull()).select("id")
    iu = info.select(F.col("id").alias("u"), F.col("pre").alias("pu"), F.col("size").alias("su"))
    iw = info.select(F.col("id").alias("w"), F.col("pre").alias("pw"), F.col("size").alias("sw"))
    nt = non_tree.select(F.col("a").alias("u"), F.col("b").alias("w")).join(iu, "u").join(iw, "w")
    related = (((F.col("pu") <= F.col("pw")) & (F.col("pw") < F.col("pu") + F.col("su")))
               | ((F.col("pw") <= F.col("pu")) & (F.col("pu") < F.col("pw") + F.col("sw"))))
    rule_a = nt.where(~related).select(F.col("u").alias("x"), F.col("w").alias("y"))
    child = info.select(F.col("id").alias("w"), F.col("parent").alias("v"), F.col("low").alias("lw"),
                        F.col("high").alias("hw"))
    par = info.select(F.col("id").alias("v"), F.col("parent").alias("pv"), F.col("pre").alias("prv"),
                      F.col("size").alias("sv"))
    rule_b = (child.join(par, "v").where(F.col("pv").isNotNull()
                                         & ((F.col("lw") < F.col("prv"))
                                            | (F.col("hw") >= F.col("prv") + F.col("sv"))))
              .select(F.col("v").alias("x"), F.col("w").alias("y")))
    aux = rule_a.union(rule_b).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    label = connected_components(nodes, aux)
    own = info.where(F.col("parent").isNotNull()).select("id").join(label, "id")
    kids = (info.where(F.col("parent").isNotNull()).select(F.col("id").alias("c"), F.col("parent").alias("id"))
            .join(label.withColumnRenamed("id", "c"), "c").select("id", "component"))
    aps = (own.unionByName(kids).groupBy("id").agg(F.count_distinct("component").alias("_k"))
           .where(F.col("_k") >= 2).select("id"))
    return _named(aps, number, "id"), br
