"""Counting keys over the whole corpus and handing the totals back to shards.

A shard (a few megabytes of documents) sends its distinct keys, sorted and
cut into buckets, as packed arrays; a bucket adds up what all shards sent and
answers each of them with the totals of its keys, in the order sent.  Equal
keys of a shard travel once however often they occur, and what a bucket holds
is bounded by the number of buckets, which grows with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

SENT = "shard int, bucket int, keys binary, counts binary"


def corpus_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_of(docs, text_col))), F.lit(0))).first()[0]


def shards_of(total: int, shard_bytes: int) -> int:
    return max(1, -(-total // shard_bytes))


def buckets_of(shards: int) -> int:
    """A power of two near the number of shards."""
    return 1 << max(0, (shards - 1).bit_length())


def in_shards(docs: DataFrame, n: int, id_col: str, text_col: str, *extra) -> DataFrame:
    """(doc_id, text, extras, shard): documents dealt evenly by a hash."""
    text = text_of(docs, text_col)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), *extra)
    return src.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


def pack(shard: int, keys: np.ndarray, counts: np.ndarray, buckets: int, short: bool = False) -> pa.Table:
    """Rows to send: sorted distinct ``keys`` cut at the buckets' borders
    (a bucket is the leading bits of a key).  ``short`` sends only the 32 bits
    after those, for keys that may meet by chance."""
    bits = buckets.bit_length() - 1
    edge = np.append(np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [0], len(keys))
    live = np.flatnonzero(np.diff(edge))
    if short:
        keys = (keys >> np.uint64(32 - bits)).astype(np.uint32)
    return pa.table({
        "shard": pa.array(np.full(len(live), shard), pa.int32()), "bucket": pa.array(live, pa.int32()),
        "keys": pa.array([keys[edge[b]:edge[b + 1]].tobytes() for b in live], pa.binary()),
        "counts": pa.array([counts[edge[b]:edge[b + 1]].astype(np.int64).tobytes() for b in live], pa.binary())})


def unpack(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype) if x.is_valid else np.zeros(0, dtype) for x in table.column(column).combine_chunks()]


def squeeze(data: np.ndarray) -> bytes:
    """Compressed bytes of an array, its length in front."""
    raw = np.ascontiguousarray(data).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    """Arrays of a column of squeezed bytes."""
    out = []
    for x in table.column(column).combine_chunks():
        raw = x.as_py()
        out.append(np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True), dtype))
    return out


def squeeze_planes(data: np.ndarray) -> bytes:
    """``squeeze`` of the numbers' first bytes, then their second ones and so
    on, which is shorter where high bytes are mostly alike."""
    return squeeze(np.ascontiguousarray(data).view(np.uint8).reshape(len(data), data.itemsize).T)


def expand_planes(table: pa.Table, column: str, dtype) -> list[np.ndarray]:
    """Arrays of a column of ``squeeze_planes``."""
    width = np.dtype(dtype).itemsize
    return [np.ascontiguousarray(x.reshape(width, -1).T).view(dtype).ravel() for x in expand(table, column, np.uint8)]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is faster than the hashing of ``np.unique``."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys, totals, place of every sent key among them)."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return distinct, total, np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])


def merge_sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and summed counts of several (keys, counts)."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], first)
