"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is a weighted set: its shingles of five words, weighted by how
often they occur.  Hashed darts are thrown into the regions weight × rank of
every element; a dart that lies below the element's weight and under the
document's rank limit counts, lands on one of ``k`` coordinates, and each
coordinate keeps its earliest dart.  Two documents agree on a coordinate with
the probability of their weighted Jaccard similarity, and the number of darts
doesn't depend on the length of the document.

Signatures are cut into bands.  Within a band only the pairs with one centre
are formed (never all pairs) and every pair is verified exactly on the element
sets.  Verified links are closed by star-based components.  Members that are
then in another class than their centre are compared with all members of the
key, exactly: they are dealt to blocks, and every pair of blocks is
one task of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.graph.components import star_components
from ..scratch import Scratch
from .common import fresh, small_batches, text_of
from .shingles import GOLD, chunks, mix, trimmed, utf8_buffer, word_hashes

LOW44 = np.uint64((1 << 44) - 1)
UNIT = 2.0 ** -53
#: Members and bytes of element sets in a block, about; members compared at once.
GROUP, GROUP_BYTES, TILE = 2048, 8 << 20, 1024


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * UNIT


def _poisson_cdf(mean: float) -> np.ndarray:
    p, out, total, n = np.exp(-mean), [], 0.0, 0
    while n < 64:
        total += p
        out.append(total)
        n += 1
        p *= mean / n
    return np.array(out)


def darts(ids: np.ndarray, weight: np.ndarray, row: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, rank, dart hash) of all darts of the elements below their weight
    and below ``limit`` of their row.

    Regions are dyadic in weight ([0,1), [1,2), [2,4), …) and in rank
    (likewise).  A region is divided into cells of area 1; a cell holds a
    Poisson number of darts, drawn from the hash of element and cell alone, so
    any two documents see the same darts.
    """
    cdf = _poisson_cdf(1.0)
    rows, ranks, hashes = [], [], []
    w_lo = 0
    while (heavy := weight > w_lo).any():
        w_size = max(1, w_lo)
        r_lo = 0
        while (deep := heavy & (limit[row] > r_lo)).any():
            r_size = max(1, r_lo)
            at = np.flatnonzero(deep)
            cells = w_size * r_size                       # each of area 1: (weight unit, rank unit)
            cell = np.tile(np.arange(cells, dtype=np.uint64), len(at))
            at = np.repeat(at, cells)
            unit_w = w_lo + (cell // np.uint64(r_size)).astype(np.int64)
            unit_r = r_lo + (cell % np.uint64(r_size)).astype(np.int64)
            live = (unit_w < weight[at]) & (unit_r < limit[row[at]])
            at, unit_w, unit_r = at[live], unit_w[live], unit_r[live]
            seed = mix(ids[at] * GOLD + mix((unit_w.astype(np.uint64) << np.uint64(32)) + unit_r.astype(np.uint64)))
            count = np.searchsorted(cdf, _unit(seed), "right")
            which = np.repeat(np.arange(len(at)), count)
            nth = (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
            h = mix(seed[which] + (nth + np.uint64(1)) * GOLD)
            rank = unit_r[which] + _unit(mix(h + GOLD))
            w = unit_w[which] + _unit(mix(h ^ GOLD))
            own = row[at[which]]
            ok = (rank < limit[own]) & (w < weight[at[which]])
            rows.append(own[ok])
            ranks.append(rank[ok])
            hashes.append(h[ok])
            r_lo = max(1, 2 * r_lo)
        w_lo = max(1, 2 * w_lo)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(ranks), np.concatenate(hashes)


def signatures(ids: np.ndarray, weight: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """DartMinHash signatures, ``n_rows`` × ``k`` (rows without elements: 0).

    The rank limit of a row is t / total weight with t = k ln k + 2k darts in
    expectation; rows with an empty coordinate throw again up to twice the
    rank, which leaves the coordinates that are filled as they are.
    """
    out = np.zeros((n_rows, k), np.uint64)
    total = np.bincount(row, weights=weight, minlength=n_rows)
    limit = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-9), 0.0)
    todo = total > 0
    while todo.any():
        use = todo[row]
        r, rank, h = darts(ids[use], weight[use], row[use], np.where(todo, limit, 0.0))
        slot = r * k + (mix(h) % np.uint64(k)).astype(np.int64)
        # rank below 2^12 with 24 fractional bits: one integer sort instead of two keys
        order = np.argsort((slot.astype(np.uint64) << np.uint64(36)) | np.minimum(rank * (1 << 24), (1 << 36) - 1).astype(np.uint64))
        slot, h = slot[order], h[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        flat = np.zeros(n_rows * k, np.uint64)
        flat[slot[first]] = h[first] | np.uint64(1)
        flat = flat.reshape(n_rows, k)
        full = (flat != 0).all(1) & todo
        out[full] = flat[full]
        todo &= ~full
        limit = np.where(todo, 2 * limit, limit)
    return out


def elements(data: np.ndarray, offsets: np.ndarray, size: int = 5):
    """Shingles of the rows: (element id, weight, row) of the distinct ones, the
    sorted 32-bit set of (shingle, occurrence) per row with its borders, and a
    128-bit digest of each row's words (0 without words).

    A row of fewer than ``size`` words has one shingle, all of its words.
    """
    n = len(offsets) - 1
    h, row, _, _ = word_hashes(data, offsets)
    words = np.bincount(row, minlength=n)
    begin = np.cumsum(words) - words
    place = (np.arange(len(h)) - begin[row]).astype(np.uint64)
    digest = np.zeros((n, 2), np.uint64)
    for c, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        np.add.at(digest[:, c], row, mix(mix(h + np.uint64(salt)) + place * GOLD))
    key = np.zeros(len(h), np.uint64)
    steps = np.arange(1, size + 1, dtype=np.uint64) * GOLD
    for j in range(size):
        step = mix(h + steps[j])
        key[:max(0, len(h) - j)] += step[j:]
        if j + 1 < size:
            short = (words[row] == j + 1) & (place == 0)
            if short.any():
                at = np.flatnonzero(short)
                key[at] = sum(mix(h[at + i] + steps[i]) for i in range(j + 1)) + np.uint64(j + 1)
    fits = place.astype(np.int64) <= np.maximum(words[row] - size, 0)
    key, row = mix(key[fits]) & LOW44, row[fits]
    both = np.sort((row.astype(np.uint64) << np.uint64(44)) | key)
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(both)))
    ids, owner = both[first] & LOW44, (both[first] >> np.uint64(44)).astype(np.int64)
    nth = (np.arange(len(both)) - np.repeat(first, weight)).astype(np.uint64)
    own = (both >> np.uint64(44)).astype(np.uint64)
    small = np.sort((own << np.uint64(32)) | (mix((both & LOW44) + nth * GOLD) >> np.uint64(32)))
    sets = (small & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    border = np.searchsorted(small >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
    return ids, weight, owner, sets, border, digest


SKETCH = "doc_id long, tkey long, d1 long, d2 long, bands array<long>, elems binary"


def _sketch(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            for i, j in chunks(offsets, 1 << 18):
                part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                ids, weight, owner, sets, border, digest = elements(part, off, size)
                sig = signatures(ids, weight.astype(np.int64), owner, j - i, bands * rows)
                keys = np.zeros((j - i, bands), np.uint64)
                for b in range(bands):
                    key = np.full(j - i, b + 1, np.uint64)
                    for c in range(b * rows, (b + 1) * rows):
                        key = mix(key * GOLD + sig[:, c])
                    keys[:, b] = key
                n_each = np.where(border[1:] > border[:-1], bands, 0)
                flat = keys[n_each > 0].reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), batch.column("tkey").slice(i, j - i),
                    pa.array(digest[:, 0].view(np.int64)), pa.array(digest[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(np.append(0, np.cumsum(n_each)).astype(np.int32), pa.array(flat)),
                    pa.array([sets[a:b].tobytes() for a, b in zip(border[:-1], border[1:], strict=True)], pa.binary())],
                    names=["doc_id", "tkey", "d1", "d2", "bands", "elems"])
    return run


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, bands: int = 25, rows: int = 5) -> DataFrame:
    """doc_id, tkey (hash of the text), digest of the words, band keys and the
    element set of every document (``rid`` numbers the rows once written)."""
    small_batches(docs.sparkSession)
    text = text_of(docs, text_col)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), F.lower(text).alias("text"))
    return src.mapInArrow(trimmed(_sketch(size, bands, rows)), SKETCH)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted Jaccard similarity of the element sets of each pair."""
    for batch in batches:
        sims = np.zeros(batch.num_rows)
        for n, (x, y) in enumerate(zip(batch.column("ea"), batch.column("eb"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
            both = len(np.intersect1d(x, y, assume_unique=True))
            sims[n] = both / max(1, len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims)], names=["a", "b", "sim"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, sim) of the pairs."""
    left = sets.select(F.col("rid").alias("a"), F.col("elems").alias("ea"))
    right = sets.select(F.col("rid").alias("b"), F.col("elems").alias("eb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ea", "eb").mapInArrow(trimmed(_similar), "a long, b long, sim double")


def _label(rows: DataFrame, labels: DataFrame | None, col: str, out: str) -> DataFrame:
    """``rows`` with the class of ``col`` so far: its label, else itself."""
    if labels is None:
        return rows.withColumn(out, F.col(col))
    own = labels.select(F.col("id").alias(col), F.col("component").alias(out))
    return rows.join(own, col, "left").withColumn(out, F.coalesce(out, col))


def _overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``xs`` with all ``ys``: elements that
    many have by products of indicator matrices, the others pair by pair."""
    sizes = [np.array([len(a) for a in s]) for s in (xs, ys)]
    row = [np.repeat(np.arange(len(n)), n) for n in sizes]
    distinct, place = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    place = [place[:len(row[0])], place[len(row[0]):]]
    count = [np.bincount(p, minlength=len(distinct)) for p in place]
    pairs = count[0] * count[1]
    out = np.zeros((len(xs), len(ys)))
    dense = np.flatnonzero(pairs > 1024)
    for i in range(0, len(dense), 1024):
        column = np.full(len(distinct), -1)
        column[dense[i:i + 1024]] = np.arange(len(dense[i:i + 1024]))
        part = []
        for r, p, n in zip(row, place, (len(xs), len(ys)), strict=True):
            use = column[p] >= 0
            m = np.zeros((n, len(dense[i:i + 1024])), np.float32)
            m[r[use], column[p[use]]] = 1
            part.append(m)
        out += part[0] @ part[1].T
    order = [np.argsort(p, kind="stable") for p in place]
    begin = [np.cumsum(c) - c for c in count]
    rare = np.flatnonzero((pairs > 0) & (pairs <= 1024))
    upto = np.cumsum(pairs[rare])
    for i in range(0, int(upto[-1]) if len(rare) else 0, 1 << 22):
        e = rare[np.searchsorted(upto, i, "right"):np.searchsorted(upto, i + (1 << 22), "right")]
        which = np.repeat(np.arange(len(e)), pairs[e])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pairs[e]) - pairs[e], pairs[e])
        x = row[0][order[0][begin[0][e][which] + nth // count[1][e][which]]]
        y = row[1][order[1][begin[1][e][which] + nth % count[1][e][which]]]
        out += np.bincount(x * len(ys) + y, minlength=out.size).reshape(out.shape)
    return out


def _cross(similarity: float):
    def run(key, table):
        """Links that join classes, of the apart members of a block (``side``
        0) with the members of a block (``side`` 1); every pair is compared
        exactly unless earlier links have joined it."""
        side, rid, cls, apart = (table.column(c).to_numpy() for c in ("side", "rid", "cls", "apart"))
        elems = table.column("elems").combine_chunks()
        distinct, comp = np.unique(cls, return_inverse=True)
        root = np.arange(len(distinct))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return int(x)

        sides = [np.flatnonzero(side == k) for k in (0, 1)]
        x, y = (at[np.argsort(rid[at], kind="stable")] for at in sides)
        sets = [np.frombuffer(e.as_buffer(), np.uint32) for e in elems]
        size = np.array([len(e) for e in sets], np.float64)
        a, b = [], []
        for i in range(0, len(x), TILE):
            for j in range(0, len(y), TILE):
                now = np.array([find(n) for n in range(len(root))])[comp]
                p, q = x[i:i + TILE], y[j:j + TILE]
                differ = (now[p][:, None] != now[q]) & ~(apart[q] & (rid[q] < rid[p][:, None]))     # of two apart, once
                differ &= np.minimum(size[p][:, None], size[q]) >= similarity * np.maximum(size[p][:, None], size[q])
                p, q, differ = p[keep := differ.any(1)], q[also := differ.any(0)], differ[differ.any(1)][:, differ.any(0)]
                if not keep.any() or not also.any():
                    continue
                both = _overlaps([sets[n] for n in p], [sets[n] for n in q])
                near = differ & (both / np.maximum(1, size[p][:, None] + size[q] - both) >= similarity)
                for n in np.flatnonzero(near.any(1)).tolist():
                    for m in np.flatnonzero(near[n]).tolist():
                        u, v = find(comp[p[n]]), find(comp[q[m]])
                        if u != v:
                            root[max(u, v)] = min(u, v)
                            a.append(min(rid[p[n]], rid[q[m]]))
                            b.append(max(rid[p[n]], rid[q[m]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _merged(labels: DataFrame | None, found: DataFrame, scratch: Scratch, name: str) -> DataFrame | None:
    """Classes after adding the links ``found``, closed on the classes so far."""
    between = _label(_label(found, labels, "a", "ra"), labels, "b", "rb").where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    between = scratch.write(between.distinct(), f"links{name}")
    if between.isEmpty():
        return labels
    step = star_components(between, scratch=scratch)
    if labels is None:
        return step
    moved = _label(labels.select("id", F.col("component").alias("old")), step, "old", "component").select("id", "component")
    return scratch.write(moved.unionByName(step.join(labels.select("id"), "id", "left_anti")), f"labels{name}")


def _classes_of(keyed: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame | None:
    """(id, component) of all linked nodes; None without any link.

    ``keyed``: (rid, key).  The members of a key are compared with one of
    them, the centre: the member whose keys are shared most in all (an original
    shares more keys with its copies than any copy does).  Members that are
    then in another class than their centre are compared with all members, those
    of the centre's class included, in pairs of blocks: any two members of a key
    are in one class or have been compared.  Of keys with the same members one
    is taken.
    """
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = scratch.write(keyed.select("rid", "key").join(shared, "key"), "members")
    weight = scratch.write(members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key")
                           .groupBy("rid").agg(F.sum("n").alias("weight")), "weights")
    top = members.join(weight, "rid").groupBy("key").agg(F.max(F.struct("weight", "rid")).alias("c"))
    joined = scratch.write(members.join(top.select("key", F.col("c.rid").alias("a")), "key").select("key", "a", "rid"), "joined")
    pairs = scratch.write(joined.where("rid != a").select(F.least("a", "rid").alias("a"), F.greatest("a", "rid").alias("b")).distinct(), "pairs")
    # of the element sets only those of members are moved, once; as they outgrow any broadcast the join is the same at every size
    ids = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    near = scratch.write(sets.hint("merge").join(ids.hint("merge"), "rid", "left_semi"), "sets")
    found = _verify(pairs, near).where(F.col("sim") >= similarity).select("a", "b")
    labels = _merged(None, found, scratch, "centre")
    rows = _label(_label(joined, labels, "a", "ra"), labels, "rid", "cls").withColumn("apart", F.col("ra") != F.col("cls"))
    some = rows.where("apart").select("key").distinct()
    rows = scratch.write(rows.join(some, "key", "left_semi").select("key", "rid", "cls", "apart"), "rows")
    length = near.select("rid", F.octet_length("elems").alias("length"))
    mark = [F.bit_xor(F.xxhash64("rid", F.lit(k))) for k in range(2)]
    of = lambda c, own: F.sum(F.when(F.col("apart"), c).otherwise(0) if own else c)
    blocks = lambda own: F.greatest(F.lit(1), F.ceil(of(F.lit(1), own) / GROUP), F.ceil(of(F.col("length"), own) / GROUP_BYTES)).cast("int")
    sizes = (rows.join(length, "rid").groupBy("key").agg(F.count("*").alias("n"), blocks(True).alias("p"),
                                                         blocks(False).alias("m"), mark[0].alias("h0"), mark[1].alias("h1"))
             .where("n > 2").groupBy("n", "h0", "h1").agg(F.min(F.struct("key", "p", "m")).alias("s")).select("s.*"))
    dealt = scratch.write(rows.join(sizes, "key"), "dealt")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    asking = dealt.where("apart").select("key", "rid", "cls", "apart", mine("p").alias("i"), every("m").alias("j"), F.lit(0).alias("side"))
    asked = dealt.select("key", "rid", "cls", "apart", every("p").alias("i"), mine("m").alias("j"), F.lit(1).alias("side"))
    links = asking.unionByName(asked).join(near, "rid").groupBy("key", "i", "j").applyInArrow(_cross(similarity), "a long, b long")
    labels = _merged(labels, links.distinct(), scratch, "apart")
    scratch.drop(members, joined, rows, dealt, near, weight, pairs)
    return labels


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, size: int = 5,
                 bands: int = 25, rows: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, tkey.

    ``class_id`` is the smallest id of the class, and one row with that id is
    kept (null ids count as larger).  Words are lower-cased and divided at
    ASCII white space; similarity is the weighted Jaccard index of the
    shingles.  Rows with the same words are one class without a comparison; a
    row without words (null, empty, blank) is a class of its own.  An empty
    table gives no rows; other columns are ignored.

    A pair at the threshold shares no band with a probability of
    (1 - 0.8^rows)^bands, 5e-5 with the defaults.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near")
    rid = F.monotonically_increasing_id()
    sk = scratch.write(sketch(docs, id_col, text_col, size, bands, rows).withColumn("rid", rid), "sketches")
    worded = sk.where(F.size("bands") > 0)
    # rows with the same words collapse to their first row
    copies = scratch.write(worded.groupBy("d1", "d2").agg(F.min(F.struct("rid", "bands")).alias("first"))
                           .select("d1", "d2", F.col("first.rid").alias("node"), F.col("first.bands").alias("bands")), "copies")
    nodes = copies.select(F.col("node").alias("rid"), "bands")
    keyed = nodes.select("rid", F.explode("bands").alias("key"))
    labels = _classes_of(keyed, sk.select("rid", "elems"), similarity, scratch)
    written, copies = copies, copies.drop("bands")
    member = (worded.select("doc_id", "tkey", "rid", "d1", "d2").join(copies, ["d1", "d2"])
              .select("doc_id", "tkey", "rid", "node"))
    member = _label(member, labels, "node", "root").select("doc_id", "tkey", "rid", "root")
    alone = sk.where(F.size("bands") == 0).select("doc_id", "tkey", "rid", F.col("rid").alias("root"))
    member = scratch.write(member.unionByName(alone), "members")
    ranked = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    classes = scratch.write(member.groupBy("root").agg(F.min(ranked).alias("best"), F.count("*").alias("class_size")), "classes")
    scratch.drop(sk, written)
    return member.join(classes, "root").select("doc_id", F.col("best.doc_id").alias("class_id"), "class_size",
                                               (F.col("rid") == F.col("best.rid")).alias("kept"), "tkey")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every near-duplicate class, all columns kept."""
    rid, key, row = (fresh(docs, c) for c in ("_id", "_key", "_row"))
    kept = near_classes(docs, id_col, text_col, **options).where("kept").select(F.col("doc_id").alias(rid), F.col("tkey").alias(key + "_k"))
    keyed = docs.withColumn(key, F.xxhash64(text_of(docs, text_col)))
    out = keyed.join(kept, keyed[id_col].cast("long").eqNullSafe(kept[rid]) & (keyed[key] == kept[key + "_k"]), "left_semi")
    first = F.row_number().over(Window.partitionBy(id_col, key).orderBy(F.lit(1)))
    return out.withColumn(row, first).where(F.col(row) == 1).select(*docs.columns)
