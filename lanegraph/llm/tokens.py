"""Encoding whole texts through a memo of their distinct runs.

The tokenizers used here never join characters across the borders of a run,
so a text's ids are those of its runs one after the other.  Runs are found
and hashed on the bytes of an Arrow column (64 bits), each distinct run is encoded once
by the tokenizer, and the ids are gathered back in order.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from .shingles import GOLD, _powers, mix

_MULT = 0x5851F42D4C957F2D | 1
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _classes() -> np.ndarray:
    c = np.full(256, _OTHER, np.uint8)
    c[33:127] = _SIGN
    for a, b, k in ((48, 58, _DIGIT), (65, 91, _LETTER), (97, 123, _LETTER)):
        c[a:b] = k
    c[[9, 10, 13, 32]] = _SPACE
    c[[39, 60]] = _OTHER          # an apostrophe may begin a contraction, < a special token
    return c


CLASS = _classes()


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, lower-cased bytes): letters are those of ASCII and Latin-1."""
    cls, low = CLASS[data], data.copy()
    low[(data >= 65) & (data < 91)] += np.uint8(32)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)
    lead, second = lead[letter], second[letter]
    cls[lead] = cls[lead + 1] = _LETTER
    low[lead[second < 0x9F] + 1] += np.uint8(32)
    return cls, low


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, from differences of running sums."""
    n = len(data)
    table = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(table[data] * _powers(n, _MULT), out=run[1:])
    h = (run[ends] - run[starts]) * _powers(n, pow(_MULT, -1, 1 << 64))[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * GOLD))


def runs(data: np.ndarray, offsets: np.ndarray, fine: bool) -> tuple[np.ndarray, ...]:
    """(hash, start, end, row, plain, bytes) of the runs between space, tab,
    line feed and carriage return.  ``fine``: letters are lower-cased, and runs
    of letters, digits and signs alone are divided further, into words, single
    digits and runs of signs; these are ``plain``.  A run with ``<`` stays as
    it is, since a special token may be in it."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e, np.zeros(0, bool), data
    if fine:
        cls, low = fold(data)
    else:
        cls, low = CLASS[data], data
    space = cls == _SPACE
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    edge = border[:n].copy()
    edge[1:] |= space[:-1]
    edge[0] = True
    starts = np.flatnonzero(edge & ~space)
    stop = border.copy()
    stop[:n] |= space
    stop[n] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    if fine and len(starts):
        other = np.zeros(n + 1, np.int32)
        np.cumsum(cls == _OTHER, out=other[1:])
        rough = other[ends] > other[starts]
        cut = np.zeros(n, bool)
        cut[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == _DIGIT)
        cut[space] = False
        if (data == 60).any():
            signs = np.zeros(n + 1, np.int32)
            np.cumsum(data == 60, out=signs[1:])
            for i in np.flatnonzero(signs[ends] > signs[starts]).tolist():
                low[starts[i]:ends[i]] = data[starts[i]:ends[i]]
        if rough.any():
            inside = np.zeros(n + 1, np.int8)
            inside[starts[rough]] += 1
            inside[ends[rough]] -= 1
            cut &= ~(np.cumsum(inside[:n], dtype=np.int8) > 0)
        cut[starts] = True
        at = np.flatnonzero(cut)
        owner = np.searchsorted(starts, at, "right") - 1
        stop_at = np.append(at[1:], n)
        starts, ends, plain = at, np.minimum(stop_at, ends[owner]), ~rough[owner]
    else:
        plain = np.zeros(len(starts), bool)
    h = hash_runs(low, starts, ends)
    return h, starts, ends, np.searchsorted(offsets, starts, "right") - 1, plain, low


class RunMemo:
    """Ids of runs seen so far in this task: it begins anew beyond ``limit``
    runs or ``most_ids`` ids."""

    def __init__(self, encode: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int = 200_000, fine: bool = True,
                 split=None, most_ids: int = 4_000_000):
        self.encode, self.limit, self.most_ids = encode, limit, most_ids
        self.split = split or (lambda data, offsets: runs(data, offsets, fine))
        self._reset()

    def _reset(self):
        self.index: dict[int, int] = {}
        self.begin, self.size, self.codes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def rows(self, data: np.ndarray, offsets: np.ndarray, places: bool = False) -> tuple[np.ndarray, ...]:
        """(ids, borders): ids of row i are ids[borders[i]:borders[i + 1]];
        with ``places`` also the memo's number and the row of every run."""
        n = len(offsets) - 1
        h, start, end, row, plain, low = self.split(data, offsets)
        if len(self.index) > self.limit or len(self.codes) > self.most_ids:
            self._reset()
        distinct, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        get = self.index.get
        at = np.array([get(k, -1) for k in distinct.tolist()], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = low.tobytes()
            text = [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)]
            codes, size = self.encode(text, plain[first[new]])
            base = len(self.begin)
            self.begin = np.concatenate([self.begin, len(self.codes) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.codes = np.concatenate([self.codes, codes])
            at[new] = np.arange(base, base + len(new))
            self.index.update(zip(distinct[new].tolist(), range(base, base + len(new)), strict=True))
        at = at[inverse]
        size = self.size[at]
        total = np.cumsum(size)
        ids = self.codes[np.repeat(self.begin[at] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        borders = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(row, weights=size, minlength=n).astype(np.int64), out=borders[1:])
        return (ids, borders, at, row) if places else (ids, borders)


def ragged(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(chain.from_iterable(parts), np.uint32, int(size.sum())), size


def word_end_encoder(tok, per_text: int = 400):
    """Encoder of runs for a tokenizer whose words end in a ``</w>`` piece.

    Plain runs are one word each, so many of them are joined by blanks in one
    text and told apart by the ending pieces; other runs are encoded singly.
    """
    vocab = tok.get_vocab(with_added_tokens=True)
    ending = np.zeros(max(vocab.values()) + 1, bool)
    ending[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def encode(texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        simple = np.flatnonzero(plain).tolist()
        rest = np.flatnonzero(~plain).tolist()
        joined = [" ".join([texts[i] for i in simple[k:k + per_text]]) for k in range(0, len(simple), per_text)]
        ids = [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        stops = np.flatnonzero(ending[ids]) + 1
        if len(stops) != len(simple):
            raise ValueError("a plain run is not one word of this tokenizer")
        single, single_size = ragged([e.ids for e in tok.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)])
        size = np.zeros(len(texts), np.int64)
        size[simple] = np.diff(stops, prepend=0)
        size[rest] = single_size
        # codes in the order of the texts
        begin = np.zeros(len(texts), np.int64)
        begin[simple] = stops - size[simple]
        begin[rest] = len(ids) + np.cumsum(single_size) - single_size
        pool, total = np.concatenate([ids, single]), np.cumsum(size)
        return pool[np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0)], size

    return encode
