"""Vectorised word hashing over the buffers of an Arrow string column."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MULT = 0x5851F42D4C957F2D | 1


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers, and what
    an idle one holds on to counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):           # another C library
        pass


def one_arena() -> None:
    """One malloc arena for all threads of a worker: every further one keeps
    freed memory of its own."""
    try:
        ctypes.CDLL(None).mallopt(-8, 1)
    except (OSError, AttributeError):
        pass


def trimmed(run):
    """``run`` over Arrow batches, giving memory back at the end of the task."""
    def all_batches(batches):
        one_arena()
        yield from run(batches)
        give_back()
    return all_batches


def freed(run):
    """``run`` over the table or tables of a group, giving memory back after it."""
    def group(*tables):
        one_arena()
        out = run(*tables)
        del tables
        give_back()
        return out
    # Spark asks by the number of arguments whether the group's key is wanted
    wraps = {1: lambda t: group(t), 2: lambda k, t: group(k, t), 3: lambda k, a, b: group(k, a, b)}
    return wraps[run.__code__.co_argcount]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def utf8_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls, zero-copy."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 20):
    """Ranges [i, j) of rows of about ``limit`` bytes (a longer row is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, base: int) -> np.ndarray:
    p = np.empty(n, np.uint64)
    p[:1] = 1
    done = 1
    while done < n:                             # each product doubles what is known
        more = min(done, n - done)
        np.multiply(p[:more], np.uint64(pow(base, done, 1 << 64)), out=p[done:done + more])
        done += more
    return p


def word_hashes(data: np.ndarray, offsets: np.ndarray, salt: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start, end) of every word, words being runs of bytes other
    than space, tab, line feed, vertical tab, form feed and carriage return.

    A word's hash is a polynomial in its bytes, taken as a difference of
    running sums modulo 2^64 and brought to a common power.
    """
    n = len(data)
    if n == 0:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e
    space = _SPACE[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = space[:-1]
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(edge[:n] & ~space)
    stop = np.ones(n + 1, bool)
    stop[:n] = space
    stop[offsets[offsets <= n]] = True
    ends = np.flatnonzero(stop[1:] & ~space) + 1
    rng = np.random.default_rng(salt)
    table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * _powers(n, _MULT), out=run[1:])
    inverse = pow(_MULT, -1, 1 << 64)
    h = (run[ends] - run[starts]) * _powers(n, inverse)[starts]
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
    return mix(h ^ ((ends - starts).astype(np.uint64) * GOLD)), rows, starts, ends
