"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

1. Letter runs of all texts are counted where the text lies (distinct runs of
   an Arrow batch first), then summed by word.
2. One word of a pair contributes its two halves, disjoint chunks; the other,
   as long or one longer, contributes the grams found where those chunks can
   lie after one edit outside of them: at the same place, or shifted by the
   difference of the lengths.  One edit spares one chunk, so near words meet
   under (length, window, text outside the window), the window being the part
   left open; the rest is verified in the join itself, which therefore puts out
   near pairs only.
3. A key that would compare more than ``limit`` pairs isn't compared: its
   windows are halved again by the same argument, until at most one code point
   of the shorter word is open.  Frequent prefixes and endings thus cost more
   keys, never more pairs, and nothing is dropped.
4. A pair can meet under several windows; it counts under the one that holds
   the first difference.
5. Forms are followed by pointer doubling.  A form has at least ``ratio`` times
   the count, so chains are as long as the logarithm of the largest count.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .common import small_batches, text_of
from .shingles import chunks, trimmed, utf8_buffer

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[0xC3] = True          # U+00C0 to U+00FF are C3 80 to C3 BF in UTF-8, and nothing else begins with C3


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()
LONG_RUN = 64


def run_crcs(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of every run, going on from the ``state`` (a crc32) of what stands before it."""
    width = ends - starts
    by_width = np.argsort(-width, kind="stable")
    out = (state ^ np.uint32(0xFFFFFFFF))[by_width]
    first = starts[by_width]
    live = np.searchsorted(-width[by_width], -np.arange(min(LONG_RUN, int(width.max(initial=0)))), "left")
    for k, n in enumerate(live):                       # the n longest runs have a byte k
        c = out[:n]
        out[:n] = _CRC[(c ^ low[first[:n] + k]) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
    crc = np.empty_like(out)
    crc[by_width] = out ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(width > LONG_RUN):
        crc[i] = zlib.crc32(low[starts[i]:ends[i]].tobytes(), int(state[i]))
    return crc


def runs(data: np.ndarray, offsets: np.ndarray, state: np.ndarray, least: int, every: int) -> pa.StringArray:
    """Words of ``least`` code points and more in the texts of a buffer.

    ``state``: per text the crc32 of what is hashed before a run.  Where
    ``every`` divides a run's crc32, its code point crc % length is deleted.
    """
    n = len(data)
    low = _LOW[data]
    letter = _LETTER[low]
    letter[1:] |= data[:-1] == 0xC3
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(letter & (border[:n] | ~np.concatenate(([False], letter[:-1]))))
    ends = np.flatnonzero(letter & (border[1:] | ~np.concatenate((letter[1:], [False])))) + 1
    points = (data & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(points)))
    length = before[ends] - before[starts]
    keep = length >= least
    starts, ends, length = starts[keep], ends[keep], length[keep]
    crc = run_crcs(low, starts, ends, state[np.searchsorted(offsets, starts, "right") - 1])
    hit = np.flatnonzero(crc % np.uint32(every) == 0)
    out = np.zeros(n, bool)
    gone = np.flatnonzero(points)[before[starts[hit]] + crc[hit].astype(np.int64) % length[hit]]
    out[gone] = True
    wide = gone[data[gone] == 0xC3]
    out[wide + 1] = True
    width = ends - starts
    width[hit] -= 1 + (data[gone] == 0xC3)
    length[hit] -= 1
    keep = length >= least
    starts, ends, width = starts[keep], ends[keep], width[keep]
    inside = np.zeros(n + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = low[np.cumsum(inside[:n], dtype=np.int8).astype(bool) & ~out]
    edges = np.zeros(len(width) + 1, np.int32)
    np.cumsum(width, out=edges[1:])
    return pa.StringArray.from_buffers(len(width), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(letters)))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31,
                min_count: int = 2) -> DataFrame:
    """(word, n): runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, that
    have ``least`` code points and occur ``min_count`` times in all texts.

    Null texts have no words; a null id is hashed as an empty one.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            data, offsets = utf8_buffer(texts)
            state = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            for a, b in chunks(offsets, 2 << 20):
                part = offsets[a:b + 1]
                found = runs(data[part[0]:part[-1]], part - part[0], state[a:b], least, every).value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], schema=schema)
    src = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("i"), text_of(docs, text_col).alias("t"))
    return (src.mapInArrow(trimmed(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


KEY = ["len", "a", "b", "around"]


def _halves(rows: DataFrame) -> DataFrame:
    """Both halves of the open window (a, b) of every row, by turns."""
    mid = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    half = F.explode(F.array(F.struct(F.col("a").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("b").alias("b"))))
    out = rows.select("word", "n", "len", "longer", half.alias("w")).select("word", "n", "len", "longer", "w.a", "w.b")
    tail = F.expr("substring(word, b + longer + 1)")
    return out.select("*", F.concat(F.expr("left(word, a)"), F.lit("\0"), tail).alias("around"),
                      F.expr("substring(word, a + 1, b - a + longer)").alias("open"))


def near_pairs(words: DataFrame, least: int = 7, limit: int = 4096, scratch: Scratch | None = None) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of ``words``
    (word, n; distinct) that is exactly one insertion, deletion or replacement
    of a code point apart.  ``least``: length of the shortest word, 2 or more.
    ``limit``: most pairs compared under one key that can still be split.
    """
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    size = F.length("word")
    part = F.explode(F.array(F.struct(size.alias("len"), F.lit(0).alias("longer")), F.struct((size - 1).alias("len"), F.lit(1).alias("longer"))))
    rows = _halves(words.select("word", "n", part.alias("p")).select("word", "n", "p.len", "p.longer", F.lit(0).alias("a"), F.col("p.len").alias("b"))
                   .where(F.col("len") >= least))
    found, spent = [], []
    while True:
        rows = scratch.write(rows, "windows")
        scratch.drop(*spent)
        own = F.sum(1 - F.col("longer"))
        heavy = scratch.write(rows.groupBy(*KEY).agg((own * F.count("*")).alias("pairs"))
                              .where((F.col("pairs") > limit) & (F.col("b") - F.col("a") > 1)).select(*KEY), "heavy")
        more = not heavy.isEmpty()
        light = rows.join(heavy, KEY, "left_anti") if more else rows
        found.append(scratch.write(_verified(light), "near"))
        spent = [rows, heavy]
        if not more:
            break
        rows = _halves(rows.join(heavy, KEY, "left_semi"))
    scratch.drop(*spent)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _verified(rows: DataFrame) -> DataFrame:
    """Near pairs that meet under a key; the rest of a pair is checked on its open windows."""
    c, g = rows.where("longer = 0").alias("c"), rows.alias("g")
    same = F.expr(" and ".join(f"c.{k} = g.{k}" for k in KEY))
    near = F.expr("levenshtein(c.open, g.open, 1) = 1")
    first = F.expr("g.longer = 0 or c.b = c.len or c.open != substring(g.open, 1, c.b - c.a)")
    link = lambda x, y: F.expr(f"struct({x}.word as word, {x}.n as n, {y}.word as near, {y}.n as near_n)")
    met = c.join(g, same & near & first).select(F.explode(F.when(F.expr("g.longer = 0"), F.array(link("c", "g")))
                                                          .otherwise(F.array(link("c", "g"), link("g", "c")))).alias("l"))
    return met.select("l.*")


def variants(words: DataFrame, least: int = 7, ratio: int = 10, limit: int = 4096, scratch: Scratch | None = None) -> DataFrame:
    """Per word of ``words`` (word, n; distinct): word, form, root, n, n_near, form_n.

    form: the near word of the largest n (ties: smallest in code-point order)
    if its n is ``ratio`` times the word's at least, else null; root: the last
    word when forms are followed, the word itself if it has none.
    """
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    words = scratch.write(words.select("word", "n"), "words")
    pairs = near_pairs(words, least, limit, scratch)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    near = (pairs.groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), best.alias("best"))
            .select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n")))
    is_form = F.col("near_n") >= ratio * F.col("n")
    near = scratch.write(near.select("word", "n_near", F.when(is_form, F.col("near")).alias("form"),
                                     F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    roots = scratch.write(near.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:                                            # r -> root of root; as often as log2 of the longest chain
        on = roots.alias("r").join(roots.alias("s"), F.expr("r.root = s.word"), "left")
        step = scratch.write(on.select("r.word", F.coalesce("s.root", "r.root").alias("root"), F.expr("s.root is not null").alias("moved")), "roots")
        moved = not step.where("moved").isEmpty()
        scratch.drop(roots)
        path, roots = step._scratch_path, step.select("word", "root")
        roots._scratch_path = path
        if not moved:
            break
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    "form_n"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7, every: int = 31,
                      min_count: int = 2, ratio: int = 10, limit: int = 4096) -> DataFrame:
    """Words of all texts with their near words, forms and roots.

    An empty table, and texts without long words, give no rows; repeated rows
    count as often as they occur; other columns of ``docs`` are ignored.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    return variants(word_counts(docs, id_col, text_col, least, every, min_count), least, ratio, limit, scratch)
