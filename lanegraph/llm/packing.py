"""Best-fit packing of token sequences with swap-based local search.

Documents are tokenised where they lie; from there on only lengths travel.
Pieces are dealt into blocks of bounded size.  In a block, pieces are placed
best-fit decreasing, then local search works on the underfull sequences: it
empties the least filled one into the others by moving a piece, exchanging one
piece for a smaller one, or two pieces for one, always by the step that fills
a receiver most.  Every step raises the sum of squared fills, so the search
ends; it also stops as soon as the number of sequences can't fall further.
Sequences that stay underfull give their pieces to a second deal, in blocks
again, in which leftovers of different blocks meet.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .common import small_batches, text_of
from .shingles import chunks, give_back, trimmed, utf8_buffer
from .tokens import RunMemo, word_end_encoder

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def _tokenise(tokenizer, capacity: int, end_id: int, group_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", "1")       # before the library starts its threads
        from tokenizers import Tokenizer
        memo = RunMemo(word_end_encoder(Tokenizer.from_str(tokenizer.value)))
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            for i, j in chunks(offsets, group_bytes):
                ids, border = memo.rows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                docs = np.arange(j - i)
                ended = np.insert(ids.astype("<u4"), border[1:], end_id)
                border = border + np.append(docs, j - i)
                size = np.diff(border)
                count = -(-size // capacity)
                owner = np.repeat(docs, count)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                start = nth * capacity
                length = np.minimum(capacity, size[owner] - start)
                at = (border[owner] + start) * 4
                view = memoryview(ended.tobytes())
                crc = [zlib.crc32(view[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i).take(pa.array(owner)), pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", group_bytes: int = 1 << 19) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document.

    The ids of a document are those of the tokenizer without special tokens,
    then ``end_id``; a longer document is cut every ``capacity`` ids.
    ``tokenizer`` is a path on the driver, its content is sent to the tasks.
    """
    small_batches(docs.sparkSession)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    with open(tokenizer) as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    return src.mapInArrow(trimmed(_tokenise(sent, capacity, end_id, group_bytes)), PIECES)


# ------------------------------------------------------------------ packing of one block

def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of every item: longest first, each into the fullest bin it fits.

    Bins are kept by remaining room, so an item costs a search over the at
    most ``capacity`` + 1 rooms, not over the bins.
    """
    bins = np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    has = np.zeros(capacity + 1, bool)
    made = 0
    for i in np.argsort(-sizes, kind="stable"):
        s = int(sizes[i])
        k = int(has[s:].argmax()) + s
        if has[k]:
            b = by_room[k].pop()
            has[k] = bool(by_room[k])
        else:
            b, k, made = made, capacity, made + 1
        bins[i] = b
        by_room[k - s].append(b)
        has[k - s] = True
    return bins


def _largest_at_most(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Index of the largest sorted value at most each limit, -1 if none."""
    return np.searchsorted(values, limits, "right") - 1


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Improve a packing; see the module's text.  Item sizes are at least 1."""
    bins = bins.copy()
    sizes = sizes.astype(np.int64)
    n_bins = int(bins.max()) + 1 if len(bins) else 0
    fill = np.bincount(bins, weights=sizes, minlength=n_bins).astype(np.int64)
    least = -(-int(sizes.sum()) // capacity)
    alive = n_bins
    closed = fill >= capacity                      # full, emptied, or given up as a source
    while alive > least:
        open_bins = np.flatnonzero(~closed)
        if not len(open_bins):
            break
        a = int(open_bins[np.argmin(fill[open_bins])])
        while fill[a] > 0:
            mine = np.flatnonzero(bins == a)
            own = np.sort(sizes[mine])
            single = np.unique(own)
            targets = np.flatnonzero((fill < capacity) & (fill >= max(1, fill[a])) & (np.arange(n_bins) != a))
            if not len(targets):
                break
            best = (0, None)
            room = capacity - fill[targets]
            k = _largest_at_most(single, room)                                  # move one
            gain = np.where(k >= 0, single[k], 0)
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (int(gain[j]), ((int(single[k[j]]),), None, int(targets[j])))
            in_target = np.zeros(n_bins, bool)
            in_target[targets] = True
            theirs = np.flatnonzero(in_target[bins])
            limit = sizes[theirs] + capacity - fill[bins[theirs]]
            k = _largest_at_most(single, limit)                                 # one for one
            gain = np.where(k >= 0, single[k] - sizes[theirs], 0)
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (int(gain[j]), ((int(single[k[j]]),), int(theirs[j]), int(bins[theirs[j]])))
            if len(own) > 1:                                                    # two for one
                x, y = np.triu_indices(len(single))
                twice = np.array([(own == v).sum() > 1 for v in single])
                ok = (x != y) | twice[x]
                x, y = x[ok], y[ok]
                pair = single[x] + single[y]
                order = np.argsort(pair, kind="stable")
                pair, x, y = pair[order], x[order], y[order]
                k = _largest_at_most(pair, limit)
                gain = np.where(k >= 0, pair[k] - sizes[theirs], 0)
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (int(gain[j]), ((int(single[x[k[j]]]), int(single[y[k[j]]])), int(theirs[j]), int(bins[theirs[j]])))
            if best[1] is None:
                break
            out, back, to = best[1]
            for v in out:
                i = next(int(i) for i in mine if sizes[i] == v and bins[i] == a)
                bins[i] = to
            if back is not None:
                bins[back] = a
            fill[to] += best[0]
            fill[a] -= best[0]
        closed |= fill >= capacity
        closed[a] = True
        if fill[a] == 0:
            alive -= 1
    return bins


def pack_block(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Columns bin, offset and fill for the pieces of one block."""
    frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
    sizes = frame["length"].to_numpy(np.int64)
    bins = local_search(sizes, best_fit(sizes, capacity), capacity)
    order = np.argsort(bins, kind="stable")
    run = np.cumsum(sizes[order]) - sizes[order]
    first = np.ones(len(order), bool)
    first[1:] = bins[order][1:] != bins[order][:-1]
    offset = np.empty(len(order), np.int64)
    offset[order] = run - run[first][np.cumsum(first) - 1]
    frame["bin"], frame["offset"] = bins, offset
    frame["fill"] = np.bincount(bins, weights=sizes, minlength=1)[bins].astype(np.int64)
    return frame


PLACED = PIECES + ", block long, bin long, offset long, fill long"


def _deal(items: DataFrame, block_items: int, capacity: int, salt: int) -> DataFrame:
    """Pack blocks of about ``block_items`` pieces, dealt by a hash."""
    n = max(1, -(-items.count() // block_items))
    block = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", "row", F.lit(salt)), F.lit(n))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        out = pack_block(frame, capacity)[["doc_id", "piece", "start", "length", "ids_crc32", "row", "block", "bin", "offset", "fill"]]
        give_back()
        return out

    return items.withColumn("block", block).groupBy("block").applyInPandas(pack, PLACED.replace(", block", ", row long, block"))


def pack(items: DataFrame, capacity: int = 4096, block_items: int = 8192, nearly_full: float = 0.99,
         scratch: Scratch | None = None) -> DataFrame:
    """Pieces with sequence_id and offset (gapless from 0 in each sequence).

    ``items`` as from ``pieces``; lengths are 1 to ``capacity``.  Sequences
    filled below ``nearly_full`` after the first deal are dealt again, all
    pieces of them, at most twice more or until one block holds them.  An empty
    table gives no rows.
    """
    scratch = scratch or Scratch(items.sparkSession, "packing")
    items = scratch.write(items.withColumn("row", F.monotonically_increasing_id()), "pieces")
    done, deal = None, 0
    while True:
        placed = scratch.write(_deal(items, block_items, capacity, deal), f"deal{deal}")
        scratch.drop(items)
        low = placed.where(F.col("fill") < int(capacity * nearly_full))
        id_of = (F.lit(deal).cast("long") * F.lit(1 << 56) + F.col("block") * F.lit(1 << 16) + F.col("bin")).alias("sequence_id")
        before = low.select("block", "bin").distinct().count()
        blocks = placed.select("block").distinct().count() if before else 1
        last = before <= 1 or blocks <= 1 or deal >= 2
        final = placed if last else placed.where(F.col("fill") >= int(capacity * nearly_full))
        final = final.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", id_of, "offset")
        done = final if done is None else done.unionByName(final)
        if last:
            return done
        items = low.select("doc_id", "piece", "start", "length", "ids_crc32", "row")
        deal += 1


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Null text counts as empty (one piece, the end id alone); repeated rows are
    packed each for itself; null ids are carried along; an empty table gives no
    rows; other columns are ignored.
    """
    return pack(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity, **options)
