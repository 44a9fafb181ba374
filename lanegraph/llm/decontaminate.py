"""Benchmark decontamination by winnowing.

Words are hashed, ``GRAM`` consecutive word hashes make a gram, and of the
grams of every ``window`` consecutive words the smallest is its fingerprint.
Equal windows of a document and of an item have
the same fingerprint at the same place, so no shared span of ``window`` words
can be missed, while neighbouring windows mostly share theirs.

1. Items: per window its fingerprint and a 128-bit hash of all its words.  The
   fingerprints are folded into a bit map whose size is bounded whatever the
   number of items (``max_filter_bits``); it is all that is broadcast.
2. Documents: fingerprints are looked up in the bit map; a hit is extended to
   the windows it stands for, whose 128-bit hashes go on.  A full bit map only
   lets more windows through.
3. The windows are joined with those of the items on their hashes (Spark
   broadcasts the items' side only below its own size limit), which gives
   occurrences; covered words are the union of their spans.

Items shorter than a window are one window of their own length; for each such
length present (at most ``window`` - 1) every run of so many words is its own
fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import small_batches, text_of
from .shingles import GOLD, chunks, mix, trimmed, utf8_buffer, word_hashes

GRAM = 5
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))

#: Bytes of words after lower-casing A-Z: 0-9, a-z and everything beyond ASCII; the rest is a space.
_WORD = np.full(256, 32, np.uint8)
_WORD[48:58] = np.arange(48, 58)
_WORD[97:123] = np.arange(97, 123)
_WORD[65:91] = np.arange(97, 123)
_WORD[128:] = np.arange(128, 256)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word."""
    h, rows, _, _ = word_hashes(_WORD[data], offsets, salt=13)
    return h, rows


def _spans(h: np.ndarray, at: np.ndarray, size: int, factor: np.uint64) -> np.ndarray:
    """Hash of the ``size`` words from each place of ``at``."""
    out = np.zeros(len(at), np.uint64)
    for j in range(size):
        out = out * factor + h[at + j]
    return mix(out ^ np.uint64(size * int(GOLD) % (1 << 64)))


def fingerprints(h: np.ndarray, left: np.ndarray, size: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(start, fingerprint) of every run of ``size`` words.  ``left``: words
    from each place to the end of its text."""
    starts = np.flatnonzero(left >= size)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    at = np.flatnonzero(left >= gram)
    grams = np.zeros(len(h), np.uint64)
    grams[at] = _spans(h, at, gram, _M1)
    least = grams[starts]
    for j in range(1, size - gram + 1):
        least = np.minimum(least, grams[starts + j])
    return starts, least


def _left(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(words per text, words from each word to the end of its text)."""
    per = np.bincount(rows, minlength=n)
    return per, np.cumsum(per)[rows] - np.arange(len(rows))


def _sizes(window: int, size: int) -> int:
    return GRAM if size == window else size


class Lookup:
    """Bit map of fingerprints (plain arrays travel, this is built in the task)."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift, self.words = np.uint64(64 - bits), words

    def __call__(self, prints: np.ndarray, size: int) -> np.ndarray:
        at = mix(prints ^ np.uint64(size)) >> self.shift
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item string, size int, print long, w1 long, w2 long): a row per window of an item."""
    schema = pa.schema([("item", pa.string()), ("size", pa.int32()), ("print", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())])

    def run(batches):
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(1))
            for a, b in chunks(offsets):
                part = offsets[a:b + 1]
                h, rows = words_of(data[part[0]:part[-1]], part - part[0])
                per, left = _left(rows, b - a)
                ids = batch.column(0).slice(a, b - a)
                for size in sorted({min(int(p), window) for p in per} - {0}):
                    gram = _sizes(window, size)
                    starts, least = fingerprints(h, left, size, gram)
                    own = np.ones(len(starts), bool) if size == window else per[rows[starts]] == size
                    starts, least = starts[own], least[own]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows[starts])), pa.array(np.full(len(starts), size, np.int32)), pa.array(least.view(np.int64)),
                         *(pa.array(_spans(h, starts, size, m).view(np.int64)) for m in (_M2, _M3))], schema=schema)
    src = items.select(F.coalesce(items[id_col].cast("string"), F.lit("")).alias("item"), text_of(items, text_col).alias("t"))
    return src.mapInArrow(trimmed(run), "item string, size int, print long, w1 long, w2 long")


def _bit_map(windows: DataFrame, max_bits: int) -> tuple[int, np.ndarray]:
    """A bit map of the distinct fingerprints, sixteen bits for each up to
    2^``max_bits``; the driver gets at most 2^(max_bits - 6) words of it."""
    n = windows.select("size", "print").distinct().count()
    bits = int(min(max_bits, max(12, (16 * n).bit_length())))
    # the finaliser of splitmix64 in SQL would need unsigned products, so places are computed in the tasks
    def places(batches):
        for b in batches:
            size = b.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            at = mix(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64) ^ size) >> np.uint64(64 - bits)
            at = np.unique(at)
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])
    rows = windows.select("size", "print").mapInArrow(places, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value"))
    got = rows.toPandas()
    words = np.zeros(1 << max(0, bits - 6), np.uint64)
    words[got["word"].to_numpy(np.int64)] = got["value"].to_numpy(np.int64).view(np.uint64)
    return bits, words


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, max_filter_bits: int = 27) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated.

    A word is hit inside any occurrence of ``window`` consecutive words of an
    item (of a whole item, if it has fewer words).  n_items: distinct ids of
    items with such an occurrence; items_sha256: those ids, sorted as strings
    and joined by commas.  Null texts have no words, a null item id counts as
    an empty string, repeated rows get a row each, an empty benchmark hits
    nothing, an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if window < GRAM:
        raise ValueError(f"window has to be {GRAM} words at least")
    scratch = Scratch(spark, "decontaminate")
    bench = scratch.write(item_windows(items, item_col, item_text_col, window), "items")
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect())          # at most `window` of them
    bits, words = _bit_map(bench, max_filter_bits)
    shared = spark.sparkContext.broadcast((bits, words))
    lists_of = [("start", pa.int32()), ("size", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())]

    def run(batches):
        seen = Lookup(*shared.value)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), ("n_words", pa.int64()), *((c, pa.list_(k)) for c, k in lists_of)])
            data, offsets = utf8_buffer(batch.column(1))
            for a, b in chunks(offsets):
                part = offsets[a:b + 1]
                h, rows = words_of(data[part[0]:part[-1]], part - part[0])
                per, left = _left(rows, b - a)
                found = []
                for size in sizes:
                    starts, least = fingerprints(h, left, size, _sizes(window, size))
                    starts = starts[seen(least, size)]
                    found.append((starts, np.full(len(starts), size, np.int32), *(_spans(h, starts, size, m).view(np.int64) for m in (_M2, _M3))))
                starts, size, w1, w2 = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
                order = np.argsort(rows[starts], kind="stable") if len(starts) else np.zeros(0, np.int64)
                starts, size, w1, w2 = starts[order], size[order], w1[order], w2[order]
                edges = np.searchsorted(rows[starts], np.arange(b - a + 1)).astype(np.int32) if len(starts) else np.zeros(b - a + 1, np.int32)
                first = np.cumsum(per) - per
                places = starts - first[rows[starts]] if len(starts) else starts
                lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x.astype(k.to_pandas_dtype()), k))
                         for x, (_, k) in zip((places, size, w1, w2), lists_of)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(per.astype(np.int64)), *lists], schema=schema)

    src = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("t"))
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = scratch.write(src.mapInArrow(trimmed(run), f"doc_id {kind}, n_words long, start array<int>, size array<int>, w1 array<long>, w2 array<long>")
                         .withColumn("rid", F.monotonically_increasing_id()), "windows")
    spans = rows.select("rid", F.explode(F.arrays_zip("start", "size", "w1", "w2")).alias("w")).select("rid", "w.*")
    by = ["size", "w1", "w2"]
    hits = scratch.write(spans.join(bench.select(*by).distinct(), by, "left_semi"), "hits")
    before = Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    cover = (hits.withColumn("reach", F.max(end).over(before))
             .groupBy("rid").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("reach", F.lit(0))))).cast("long").alias("n_hit")))
    met = (hits.select("rid", *by).distinct().join(bench.select(*by, "item").distinct(), by).select("rid", "item").distinct()
           .groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<string>")
    items_of = F.coalesce("items", none)
    return (rows.select("rid", "doc_id", "n_words").join(cover, "rid", "left").join(met, "rid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items_of, ",").cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
