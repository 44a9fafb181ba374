"""Language-model scoring: log-bilinear model with noise-contrastive estimation.

Word counts of the training texts are exact, over the whole corpus.  The model
predicts word classes: each of the most frequent words (the end of a text among
them) is a class, all other words share one; the number of class words is the
square root of the number of distinct words, ``top`` at least.  A class's
probability after the two classes before it is log-bilinear: context vectors,
scaled per position, are added up and multiplied with class vectors.  Vectors
are trained by noise-contrastive estimation on the class trigrams of all
training texts: a round passes over every entry of the trigram table, in
parallel on parts whose number grows with the texts, and averages the parts'
vectors.  A rare word's probability is that of its class times its smoothed
share in the class, so token probabilities sum to one over the known words and
one unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import exchange as X
from .langid import id_remainder
from .shingles import chunks, freed, mix, trimmed, utf8_buffer, word_hashes

END = mix(np.array([0x0E0D], np.uint64))[0]
CONTEXT = 2


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words of every row in order, each row closed by END."""
    low = data.copy()
    low[(data >= 65) & (data < 91)] += np.uint8(32)
    h, row, _, _ = word_hashes(low, offsets)
    n = len(offsets) - 1
    stop = np.searchsorted(row, np.arange(n), "right")
    return np.insert(h, stop, END), np.insert(row, stop, np.arange(n))


def _words(buckets: int):
    def run(key, table):
        data, offsets = utf8_buffer(table.column("text"))
        held = table.column("held").combine_chunks().to_numpy(zero_copy_only=False)
        parts = []
        for i, j in chunks(offsets):
            h, row = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            keys = X.distinct(h)
            learnt, n = np.unique(h[~held[i:j][row]], return_counts=True)
            counts = np.zeros(len(keys), np.int64)
            counts[np.searchsorted(keys, learnt)] = n
            parts.append((keys, counts))
        keys, counts = X.merge_sorted(parts)
        return X.pack(key[0].as_py(), keys, counts, buckets)
    return run


ANSWER = "shard int, bucket int, counts binary, types long, tokens long, top_keys binary, top_counts binary"


def _add_up(top: int, buckets: int):
    def run(key, table):
        """An answer per shard, and one row (shard -1) about the bucket; words
        fall into buckets by hash, so twice the expected number of class words
        holds all that are among them."""
        keys = X.unpack(table, "keys", np.uint64)
        distinct, total, place = X.totals(keys, X.unpack(table, "counts", np.int64))
        order = np.lexsort((distinct, -total))[:max(top, 2 * math.isqrt(buckets * len(distinct)))]
        order = order[total[order] > 0]
        n = len(keys)
        none = [None] * n
        return pa.table({
            "shard": pa.array(table.column("shard").to_pylist() + [-1], pa.int32()), "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int32()),
            "counts": pa.array([total[p].tobytes() for p in place] + [None], pa.binary()),
            "types": pa.array(none + [int((total > 0).sum())], pa.int64()), "tokens": pa.array(none + [int(total.sum())], pa.int64()),
            "top_keys": pa.array(none + [distinct[order].tobytes()], pa.binary()),
            "top_counts": pa.array(none + [total[order].tobytes()], pa.binary())})
    return run


@dataclass
class Vocabulary:
    """Totals of the training texts and the words that are a class each."""

    tokens: int
    types: int
    keys: np.ndarray        # sorted hashes of the class words
    counts: np.ndarray      # their counts

    @property
    def rare(self) -> int:
        """Class of all other words; the class after it stands before a text."""
        return len(self.keys)

    def classes(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, self.rare)

    def class_counts(self) -> np.ndarray:
        return np.append(self.counts, max(0, self.tokens - int(self.counts.sum())))


def contexts(cls: np.ndarray, row: np.ndarray, rare: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before every token (``rare`` + 1: none)."""
    one, two = np.full(len(cls), rare + 1), np.full(len(cls), rare + 1)
    one[1:] = np.where(row[1:] == row[:-1], cls[:-1], rare + 1)
    two[2:] = np.where(row[2:] == row[:-2], cls[:-2], rare + 1)
    return one, two


TRIGRAMS = "part int, keys binary, counts binary"


def _trigrams(voc, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*voc.value)
        found, waiting = [], 0
        base = v.rare + 2

        def out():
            keys, counts = X.merge_sorted(found)
            part = (mix(keys) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            live, start = np.unique(part[order], return_index=True)
            use = np.split(order, start[1:])
            return pa.RecordBatch.from_arrays([pa.array(live, pa.int32()), pa.array([keys[u].tobytes() for u in use], pa.binary()),
                                               pa.array([counts[u].tobytes() for u in use], pa.binary())], names=["part", "keys", "counts"])

        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            for i, j in chunks(offsets):
                h, row = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cls = v.classes(h)
                one, two = contexts(cls, row, v.rare)
                keys, n = np.unique(((two * base + one) * base + cls).astype(np.uint64), return_counts=True)
                found.append((keys, n))
                waiting += len(keys)
                if waiting > 2_000_000:
                    found = [X.merge_sorted(found)]
                    waiting = len(found[0][0])
                    if waiting > 1_000_000:
                        yield out()
                        found, waiting = [], 0
        if found:
            yield out()
    return run


def _add_trigrams(key, table):
    keys, counts = X.merge_sorted(list(zip(X.unpack(table, "keys", np.uint64), X.unpack(table, "counts", np.int64), strict=True)))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "keys": pa.array([keys.tobytes()], pa.binary()),
                     "counts": pa.array([counts.tobytes()], pa.binary())})


def _sums(x: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``values`` added up by the class ``x`` of each."""
    order = np.argsort(x.astype(np.uint16) if width <= 1 << 16 else x, kind="stable")     # 16 bits are sorted by radix
    start = np.flatnonzero(np.diff(x[order], prepend=-1))
    out = np.zeros((width, values.shape[1]), np.float32)
    out[x[order[start]]] = np.add.reduceat(values[order], start, axis=0)
    return out


def _draws(weight: np.ndarray, steps: int, batch: int, rng) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    cum = np.cumsum(weight, dtype=np.float64)
    for _ in range(steps):
        yield np.minimum(np.searchsorted(cum, rng.random(batch) * cum[-1], "right"), len(cum) - 1), np.ones(batch, np.float32)


def _passes(weight: np.ndarray, unit: int, batch: int, rng) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every entry in random order; one of more than ``unit`` occurrences is
    visited several times, so that no visit stands for more than that."""
    visits = -(-weight // unit)
    each = (weight / (visits * unit)).astype(np.float32)
    order = np.repeat(np.arange(len(weight), dtype=np.int32), visits)
    rng.shuffle(order)
    for i in range(0, len(order), batch):
        yield order[i:i + batch], each[order[i:i + batch]]


class LogBilinear:
    """Parameters: context vectors ``r``, class vectors ``q``, biases ``b`` and
    per-position scales ``c``."""

    def __init__(self, class_counts: np.ndarray, dim: int, seed: int = 0):
        k = len(class_counts)
        rng = np.random.default_rng(seed)
        self.r = rng.normal(0, 0.1, (k + 1, dim)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (k, dim)).astype(np.float32)
        p = (class_counts + 0.5) / (class_counts.sum() + 0.5 * k)
        self.b = np.log(p).astype(np.float32)
        self.c = np.full((CONTEXT, dim), 1 / CONTEXT, np.float32)
        self.noise = p

    def arrays(self) -> list[np.ndarray]:
        return [self.r, self.q, self.b, self.c]

    @classmethod
    def of(cls, r, q, b, c, noise) -> LogBilinear:
        """A model of copies of these arrays."""
        model = cls.__new__(cls)
        model.r, model.q, model.b, model.c, model.noise = (np.array(x) for x in (r, q, b, c, noise))
        return model

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (self.r * self.c[0])[one] + (self.r * self.c[1])[two]

    def train(self, one, two, cls, weight, steps: int | None, batch: int, noise: int, rate: float, seed: int, unit: int = 8) -> None:
        """Noise-contrastive estimation with Adagrad over all trigrams by
        ``weight`` (``steps`` given: on that many batches drawn by weight
        instead); the noise words of a batch are shared by its rows."""
        rng = np.random.default_rng(seed)
        noise_cum = np.cumsum(self.noise)
        log_noise = np.log(noise * self.noise).astype(np.float32)
        state = [np.full(a.shape, 1e-4, np.float32) for a in self.arrays()]
        k = len(self.b)
        for at, share in _passes(weight, unit, batch, rng) if steps is None else _draws(weight, steps, batch, rng):
            o, t, w = one[at], two[at], cls[at]
            z = np.minimum(np.searchsorted(noise_cum, rng.random(noise) * noise_cum[-1], "right"), k - 1)
            ro, rt = self.r[o], self.r[t]
            v = ro * self.c[0] + rt * self.c[1]
            qw, qz = self.q[w], self.q[z]
            own = (v * qw).sum(1) + self.b[w] - log_noise[w]
            gz = v @ qz.T
            gz += self.b[z]
            gz -= log_noise[z]
            gw = share / (1 + np.exp(own))                   # pull of the true word
            np.exp(np.negative(gz, out=gz), out=gz)
            gz += 1
            np.divide(-share[:, None], gz, out=gz)           # push of each noise word
            gv = gw[:, None] * qw + gz @ qz
            words, pull = np.concatenate([w, z]), np.concatenate([gw[:, None] * v, gz.T @ v])
            to_words = _sums(words, np.column_stack([pull, np.concatenate([gw, gz.sum(0)])]), k)
            grads = [_sums(np.concatenate([o, t]), np.concatenate([gv * self.c[0], gv * self.c[1]]), k + 1), to_words[:, :-1], to_words[:, -1],
                     np.stack([(gv * ro).sum(0), (gv * rt).sum(0)])]
            for a, g, s in zip(self.arrays(), grads, state, strict=True):
                g /= share.sum()
                s += g * g
                a += rate * g / np.sqrt(s)

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, cls: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        """Normalised natural log-probabilities of the classes; the total of each distinct context is taken once."""
        base = len(self.b) + 1
        ctx, inverse = np.unique(two * base + one, return_inverse=True)
        out = -self.log_totals(ctx % base, ctx // base)[inverse]
        for s in range(0, len(cls), block):
            c = cls[s:s + block]
            out[s:s + block] += np.einsum("ij,ij->i", self.predicted(one[s:s + block], two[s:s + block]), self.q[c], dtype=np.float64) + self.b[c]
        return out

    def log_totals(self, one: np.ndarray, two: np.ndarray, held: int = 48 << 20, wide: int = 128, dense: int = 16) -> np.ndarray:
        """Log of the sums over all classes that normalise these contexts.

        The exponential of a context's logits is the product of one factor per
        position, so factors are taken per class instead of per context, and a
        total is the scalar product of two of them.  Products go block by
        block: by matrices where a ``dense``-th of the pairs is asked for, else
        pair by pair.  ``held`` bounds the bytes of factors of the first position.
        """
        out, k = np.empty(len(one)), len(self.b)
        q = self.q.T.astype(np.float64)
        names, n = np.unique(one, return_counts=True)
        names = names[np.argsort(-n, kind="stable")]
        rows = max(1, held // (8 * k))
        for i in range(0, len(names), rows):
            some = names[i:i + rows]
            a, top_a = _factors((self.r[some] * self.c[0]) @ q)
            place = np.full(k + 1, -1)
            place[some] = np.arange(len(some))
            use = np.flatnonzero(place[one] >= 0)
            others, of, m = np.unique(two[use], return_inverse=True, return_counts=True)
            order = np.argsort(-m, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            use = use[np.argsort(rank[of], kind="stable")]
            edge = np.concatenate([[0], np.cumsum(m[order])])
            for j in range(0, len(order), wide):
                here = order[j:j + wide]
                b, top_b = _factors((self.r[others[here]] * self.c[1]) @ q + self.b)
                at = use[edge[j]:edge[j + len(here)]]
                x, y = place[one[at]], np.repeat(np.arange(len(here)), m[here])
                asked = np.zeros(len(some), bool)
                asked[x] = True
                live = np.flatnonzero(asked)
                if len(at) * dense >= len(live) * len(here):
                    z = (a[live] @ b.T)[np.searchsorted(live, x), y]
                else:
                    z = np.concatenate([a[x[u:v]] @ b[n] for n, (u, v) in enumerate(zip(edge[j:] - edge[j], edge[j + 1:j + 1 + len(here)] - edge[j]))])
                lost = np.flatnonzero(z < 1e-200)            # their largest terms lie apart: beyond the range of the factors
                z[lost] = 1.0
                out[at] = np.log(z) + top_a[x] + top_b[y]
                for u in range(0, len(lost), 1024):
                    t = at[lost[u:u + 1024]]
                    logit = self.predicted(one[t], two[t]) @ q + self.b
                    top = logit.max(1)
                    out[t] = top + np.log(np.exp(logit - top[:, None]).sum(1))
        return out


def _factors(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials less each row's largest, and that."""
    top = logit.max(1)
    logit -= top[:, None]
    return np.exp(logit, out=logit), top


BLOCK = 4096
PIECES = "part int, block int, weight double, piece binary"


def _round(sent, steps: int | None, batch: int, noise: int, rate: float, number: int):
    def run(key, table):
        """The part's parameters after the round, times its weight, in blocks."""
        model = LogBilinear.of(*sent.value)
        keys, counts = X.unpack(table, "keys", np.uint64)[0].astype(np.int64), X.unpack(table, "counts", np.int64)[0]
        part, base, weight = key[0].as_py(), len(model.b) + 1, float(counts.sum())
        ids = np.int32 if base < 1 << 31 else np.int64
        model.train((keys // base % base).astype(ids), (keys // base // base).astype(ids), (keys % base).astype(ids), counts, steps, batch, noise,
                    rate, seed=1000 * number + part)
        flat = np.concatenate([a.ravel() for a in model.arrays()]).astype(np.float64) * weight
        pieces = [flat[i:i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
        n = len(pieces)
        return pa.table({"part": pa.array([part] * n, pa.int32()), "block": pa.array(range(n), pa.int32()),
                         "weight": pa.array([weight] * n, pa.float64()), "piece": pa.array(pieces, pa.binary())})
    return run


def _add_pieces(key, table):
    """Sums of weights and pieces, in the order of their parts."""
    order = np.argsort(table.column("part").to_numpy(), kind="stable")
    total = sum(x for x in (X.unpack(table, "piece", np.float64)[i] for i in order))
    return pa.table({"part": pa.array([int(table.column("part").to_numpy().min())], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                     "weight": pa.array([float(table.column("weight").to_numpy()[order].sum())]), "piece": pa.array([total.tobytes()], pa.binary())})


def fit(trigrams: DataFrame, class_counts: np.ndarray, parts: int = 8, dim: int = 24, rounds: int = 4, steps: int | None = None,
        batch: int = 4096, noise: int = 96, rate: float = 0.3) -> LogBilinear:
    """Rounds of parallel training over all parts of the table.  Their vectors
    are averaged by weight in two levels, of groups of about √parts each, so
    the driver gets one set of vectors a round however many parts there are.
    ``steps`` ends a part's round after that many drawn batches (for trials)."""
    model = LogBilinear(class_counts, dim)
    spark = trigrams.sparkSession
    width = math.isqrt(max(1, parts - 1)) + 1
    for n in range(rounds):
        sent = spark.sparkContext.broadcast((*model.arrays(), model.noise))
        got = trigrams.groupBy("part").applyInArrow(freed(_round(sent, steps, batch, noise, rate / (1 + n), n)), PIECES)
        some = got.groupBy(F.pmod("part", F.lit(width)).alias("group"), "block").applyInArrow(freed(_add_pieces), PIECES)
        whole = some.groupBy(F.lit(0).alias("group"), "block").applyInArrow(freed(_add_pieces), PIECES).orderBy("block").collect()
        if not whole:
            return model
        flat = np.concatenate([np.frombuffer(r["piece"], np.float64) / r["weight"] for r in whole])
        cuts = np.cumsum([a.size for a in model.arrays()])[:-1]
        model.r, model.q, model.b, model.c = (x.reshape(a.shape).astype(np.float32)
                                              for x, a in zip(np.split(flat, cuts), model.arrays(), strict=True))
    return model


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(voc, sent, buckets: int):
    def run(key, table, answers):
        v = Vocabulary(*voc.value)
        model = LogBilinear.of(*sent.value)
        data, offsets = utf8_buffer(table.column("text"))
        n_rows = len(offsets) - 1
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        parts = X.unpack(answers, "counts", np.int64)
        count = np.concatenate([parts[i] for i in order]) if len(order) else np.zeros(0, np.int64)
        hashed = [tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in chunks(offsets)]
        keys, place = np.unique(np.concatenate([h for h, _ in hashed]), return_inverse=True) if hashed else (np.zeros(0, np.uint64), None)
        assert len(keys) == len(count)
        spread = v.tokens + 0.5 * (v.types + 1)
        rare_n, rare_v = v.tokens - int(v.counts.sum()), v.types - len(v.keys)
        cols: list[list[np.ndarray]] = [[], [], [], []]
        edge = np.cumsum([0, *(len(h) for h, _ in hashed)])
        place = [place[i:j] for i, j in zip(edge, edge[1:])]
        class_of = v.classes(keys)
        classes = [class_of[at] for at in place]
        before = [contexts(cls, row, v.rare) for cls, (_, row) in zip(classes, hashed)]
        all_logp = model.log_probabilities(*(np.concatenate(x) for x in zip(*before)), np.concatenate(classes)) if hashed else np.zeros(0)
        del before
        for i, ((_, row), cls) in enumerate(zip(hashed, classes)):
            n = int(row[-1]) + 1
            c = count[place[i]].astype(np.float64)
            logp = all_logp[edge[i]:edge[i + 1]]
            in_rare = cls == v.rare
            logp[in_rare] += np.log((c[in_rare] + 0.5) / (rare_n + 0.5 * (rare_v + 1)))
            cols[0].append(np.bincount(row, minlength=n))
            cols[1].append(np.bincount(row, weights=c > 0, minlength=n).astype(np.int64))
            cols[2].append(np.bincount(row, weights=np.log10((c + 0.5) / spread), minlength=n))
            cols[3].append(np.bincount(row, weights=logp / np.log(10), minlength=n))
        full = [np.concatenate(x) if x else np.zeros(0) for x in cols]
        assert len(full[0]) == n_rows
        return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held"), "n_tokens": pa.array(full[0], pa.int64()),
                         "n_known": pa.array(full[1], pa.int64()), "base_score": pa.array(full[2], pa.float64()),
                         "score": pa.array(full[3], pa.float64())})
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mod: int = 5, held: int = 1, top: int = 250,
          part_bytes: int = 16 << 20, shard_bytes: int = 8 << 20, scratch: Scratch | None = None, **training) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) mod ``mod`` is ``held`` are held out of all
    learning.  ``top`` is the least number of class words (fewer distinct words
    are a class each), ``part_bytes`` the text behind a part of the trigram
    table, which is one training task.  Tokens are the words between ASCII white space, A-Z
    lower-cased, then one end; null text counts as empty, its one token is the
    end.  Repeated rows are scored each; an empty table gives no rows; other
    columns are ignored.  Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "lm")
    is_held = (id_remainder(docs[id_col], mod) == held).alias("held")
    size = X.corpus_bytes(docs, text_col)
    n, parts = X.shards_of(size, shard_bytes), X.shards_of(size, part_bytes)
    buckets = X.buckets_of(n)
    sharded = X.in_shards(docs, n, id_col, text_col, is_held)
    sent = sharded.groupBy("shard").applyInArrow(freed(_words(buckets)), X.SENT)
    answers = scratch.write(sent.groupBy("bucket").applyInArrow(freed(_add_up(top, buckets)), ANSWER), "answers")

    about = answers.where("shard = -1")
    totals = about.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    best = about.mapInArrow(_open_top, "key long, n long").orderBy(F.desc("n"), "key").limit(max(top, math.isqrt(totals["v"]))).collect()
    keys = np.array([r["key"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    voc = Vocabulary(totals["n"], totals["v"], keys[order], np.array([r["n"] for r in best], np.int64)[order])
    sent_voc = spark.sparkContext.broadcast((voc.tokens, voc.types, voc.keys, voc.counts))     # plain values: no class is needed on the executors

    learn = docs.where(id_remainder(docs[id_col], mod) != held).select(X.text_of(docs, text_col).alias("text"))
    trigrams = scratch.write(learn.mapInArrow(trimmed(_trigrams(sent_voc, parts)), TRIGRAMS).groupBy("part").applyInArrow(freed(_add_trigrams), TRIGRAMS), "trigrams")
    model = fit(trigrams, voc.class_counts(), parts, **training)
    sent_model = spark.sparkContext.broadcast((*model.arrays(), model.noise))
    replies = answers.where("shard >= 0").select("shard", "bucket", "counts")
    out = sharded.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(freed(_score(sent_voc, sent_model, buckets)), SCORED)
    return out.withColumn("train_tokens", F.lit(voc.tokens).cast("long"))


def _open_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent words of each bucket, one row each."""
    for batch in batches:
        for k, c in zip(batch.column("top_keys"), batch.column("top_counts"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(k.as_buffer(), np.int64)), pa.array(np.frombuffer(c.as_buffer(), np.int64))],
                                             names=["key", "n"])
