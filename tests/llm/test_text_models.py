"""Language identification, language model, tokenizers and packing."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lanegraph.llm import langid as L
from lanegraph.llm import lbl as B
from lanegraph.llm import packing as P
from lanegraph.llm import sentencepiece_codec as C
from lanegraph.llm.shingles import utf8_buffer

tokenizers_dir = pytest.importorskip("public_tokenizers")


# ------------------------------------------------------------------ language identification

def plain_grams(t):
    out = bytearray(b" ")
    for x in t.encode():
        if x >= 128 or 97 <= (x | 32) < 123:
            out.append(x)
        elif out[-1] != 32:
            out.append(32)
    if out[-1] != 32:
        out.append(32)
    return Counter(((((out[i] << 16) | (out[i + 1] << 8) | out[i + 2]) * 2654435761) & 0xFFFFFFFF) >> (32 - L.BITS)
                   for i in range(len(out) - 2) if out[i + 1] != 32)


def test_grams():
    texts = ["ab, c  d", "", "x", " 12 ", "été..à la", "a b", "..a", "b..", "zz", "\n", "a1b"]
    row, gram, n = L.grams(*utf8_buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert {int(g): int(c) for g, c in zip(gram[row == i], n[row == i], strict=True)} == dict(plain_grams(t)), t


def test_mixture_finds_proportions():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.full(L.GRAMS, 0.05), 3).T
    draws = np.concatenate([rng.choice(L.GRAMS, 700, p=p[:, 0]), rng.choice(L.GRAMS, 300, p=p[:, 2])])
    gram, n = np.unique(draws, return_counts=True)
    share, _ = L.mixture(np.zeros(len(gram), int), n.astype(float), p[gram] + 1e-12, np.full((1, 3), 1 / 3))
    assert np.allclose(share[0], [0.7, 0, 0.3], atol=0.03)


def test_identify(spark, edge, empty):
    en, de = "the cat sat on the mat and the dog ", "der hund und die katze auf dem tisch "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de", "z") for i in range(200)]
    rows += [(300, None, "en", "z"), (301, "", "en", "z"), (302, "12 !", "de", "z"), (303, en * 5 + de * 5, None, "z"), (None, en, "en", "z"),
             (304, "qzxj wvkq xqjz kqwx zzqx jxqz wqkx", None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(200))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(200))
    assert [(got[i].lang_pred, got[i].score) for i in (300, 301, 302)] == [("und", 0.0)] * 3
    assert set(got[303].languages) == {"en", "de"} and 0.3 < got[303].score < 0.7
    assert got[304].languages == []                                    # no better than chance
    assert got[None].lang_pred == "en" and len(got) == len(rows)
    kept = L.keep_identified(docs, L.train(docs))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(got) - {300, 301, 302, 304}
    assert L.identify(edge[0]).count() == len(edge[1])
    assert L.identify(empty).count() == 0
    assert {r.lang_pred for r in L.identify(docs.withColumn("lang", docs.lang.substr(9, 0)).where("doc_id = 302")).collect()} == {"und"}


# ------------------------------------------------------------------ language model

def test_score_base_and_normalisation(spark, edge, empty):
    docs, rows = edge
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    toks = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + [0]) for i, t in rows]
    c = Counter(w for i, ws in toks if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4), held(i))
                  for i, ws in toks)
    out = B.score(docs, top=20, steps=5, rounds=1, shard_bytes=1 << 19).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4), r.held_out) for r in out) == want
    assert {r.train_tokens for r in out} == {n}
    assert B.score(empty, steps=1, rounds=1).count() == 0


def test_log_bilinear_learns_and_sums_to_one():
    rng = np.random.default_rng(2)
    n = 20000                                              # class 0 is always followed by 1, 1 by 2, 2 by anything
    cls = [0]
    for _ in range(n):
        cls.append((cls[-1] + 1) if cls[-1] < 2 else int(rng.integers(0, 4)))
    cls = np.minimum(np.array(cls), 3)
    one, two = B.contexts(cls, np.zeros(len(cls), int), 3)
    m = B.LogBilinear(np.bincount(cls, minlength=4), 8)
    before = m.log_probabilities(one, two, cls).mean()
    key, count = np.unique((two * 5 + one) * 5 + cls, return_counts=True)
    m.train(key // 5 % 5, key // 25, key % 5, count, steps=400, batch=512, noise=32, rate=0.3, seed=1)
    assert m.log_probabilities(one, two, cls).mean() > before + 0.3
    for o, t in ((0, 4), (1, 0), (2, 1)):
        assert abs(np.exp(m.log_probabilities(np.full(4, o), np.full(4, t), np.arange(4))).sum() - 1) < 1e-6


# ------------------------------------------------------------------ tokenizers and packing

def test_pieces_equal_the_tokenizer(spark, edge, empty):
    from tokenizers import Tokenizer
    path = tokenizers_dir.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = ["á ́b  ΑΣ ΣΑΣ x <|endoftext|>y\x1cz w it's we'll 한글 ﬁ Ⅳ\r\n\x0bq", "don't-stop 's", "<|startoftext|>", "İstanbul ǅ A__b12 3.14e5",
           "<|ENDOFTEXT|> ab", "ÀÉÎ×Þß÷ É́ÿ Ÿ ÃÃ<ÀB<|endoftext|>ÀB"]
    rows = [(100 + i, t) for i, t in enumerate(odd)] + [(i, t) for i, t in edge[1] if i is not None]
    got = P.pieces(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for n, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s:s + 4096], "<u4")
            want.append((i, n, s, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r) for r in got) == sorted(want)
    packed = P.pack_documents(edge[0], path).toPandas()
    assert packed.doc_id.isna().sum() == 2 and packed.groupby("sequence_id").length.sum().max() <= 4096
    assert P.pack_documents(empty, path).count() == 0


def test_packing_is_gapless_and_tight(spark):
    rng = np.random.default_rng(3)
    sizes = np.concatenate([rng.integers(1, 1500, 3000), np.full(1500, 1365), rng.integers(2000, 4097, 300)])
    items = spark.createDataFrame([(i, 0, 0, int(s), 7) for i, s in enumerate(sizes)], P.PIECES)
    got = P.pack(items, block_items=700).toPandas().sort_values(["sequence_id", "offset"])
    assert len(got) == len(sizes) and (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= math.ceil(sizes.sum() / 4096) * 1.01 + 1


def test_local_search_empties_bins():
    cases = [([70, 50, 48, 30, 2], [0, 1, 1, 2, 3]),                # an exchange and moves
             ([60, 30, 55, 35, 10, 10], [0, 0, 1, 1, 2, 2]),          # moves
             ([70, 25, 60, 35, 5, 5], [0, 0, 1, 1, 2, 2])]
    for s, b in cases:
        s = np.array(s)
        fill = np.bincount(P.local_search(s, np.array(b), 100), weights=s)
        assert sorted(fill[fill > 0]) == [100, 100], (s, b)
    s = np.array([60, 60, 40, 40, 50, 50, 30, 30, 40])               # from one each
    fill = np.bincount(P.local_search(s, np.arange(9), 100), weights=s)
    assert fill.max() <= 100 and (fill > 0).sum() <= 5
    rng = np.random.default_rng(4)
    for _ in range(20):
        s = rng.integers(20, 60, 60)
        b0 = P.best_fit(s, 100)
        b1 = P.local_search(s, b0, 100)
        f = np.bincount(b1, weights=s, minlength=1)
        assert f.max() <= 100 and f.sum() == s.sum() and (f > 0).sum() <= b0.max() + 1
        assert (f ** 2).sum() >= (np.bincount(b0, weights=s) ** 2).sum()


class CountedEncoder:
    """An encoder that counts its calls."""

    def __init__(self, real):
        self.real, self.calls = real, 0

    def __getattr__(self, name):
        return getattr(self.real, name)

    def encode(self, *args, **named):
        self.calls += 1
        return self.real.encode(*args, **named)


def test_sentencepiece_runs_are_encoded_and_checked_together():
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        codec = C.Codec(f.read())
    codec.reference = CountedEncoder(codec.reference)
    texts = [" ", "", "  ", "a", " a  b   ", "\u2603 \U0001f600\u0301x \x00 \t\n y", "b   ", "\xa0 \u3000 z", "word\nword \r word"]
    texts += [" ".join(f"w{i * 7919 % 4001}x{i}" for i in range(k, k + 50)) for k in range(0, 2000, 50)]
    ids, borders, parity = codec.rows(pa.array(texts))
    assert parity.all() and codec.reference.calls <= 2
    for n, t in enumerate(texts):
        assert ids[borders[n]:borders[n + 1]].tolist() == codec.reference.real.encode(t) == codec.full.encode(t, add_special_tokens=False).ids
    runs = [" a", "  ", "  b", "   ", " \u2603", " ", " c"]
    together, alone = codec._pieces(runs), codec._each(runs)
    assert all(np.array_equal(x, y) for x, y in zip(together, alone, strict=True))
    # a difference is told by its run, whether of length or of an id
    x = np.array([1, 2, 3, 4, 5], np.uint32), np.array([1, 2, 2])
    y = np.array([1, 2, 9, 4], np.uint32), np.array([1, 2, 1])
    assert C.unequal(*x, *x).tolist() == [] and C.unequal(*x, *y).tolist() == [1, 2]


def test_sentencepiece_parity_and_round_trip(spark, edge, empty):
    import sentencepiece
    path = tokenizers_dir.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", " ", "  a  b", "x▁ y ▁▁z", "日本語 テスト 🙂\n\n\tq", "<s> hello</s> <0x41>", "a   ", "tab\tnew\nline"] + [t for i, t in edge[1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = C.encode(docs, path).cache()
    got = {r.doc_id: r for r in enc.collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].parity, t
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert got[i].round_trip == ("▁" not in (t or ""))          # the marker itself decodes to a blank
    back = {r.doc_id: r.text for r in C.decode_ids(spark, enc, path).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    assert C.encode(empty, path).count() == 0


def test_unigram_model_is_rebuilt():
    """A unigram model written by hand: parse, rebuild, compare with the library."""
    import struct

    import sentencepiece

    def field(n, kind, payload):
        tag = bytes([n << 3 | kind]) if n < 16 else bytes([(n << 3 | kind) & 127 | 128, n >> 4])
        return tag + (payload if kind != 2 else bytes([len(payload)]) + payload)

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), ("▁", -3.0, 1), ("a", -2.5, 1), ("b", -2.6, 1), ("ab", -2.0, 1), ("▁ab", -2.2, 1),
              ("▁a", -2.4, 1), ("ba", -4.0, 1)]
    raw = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    raw += field(2, 2, field(3, 0, b"\x01"))
    raw += field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x01") + field(5, 0, b"\x01"))
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    codec = C.Codec(raw)
    assert codec.model.model_type == C.parse(raw).model_type == 1 and not codec.fast
    for t in ["ab", "abab  ba", " a b ", "", "aab", "bab ab"]:
        ids, _, parity = codec.rows(pa.array([t]))
        assert ids.tolist() == sp.encode(t) and parity.all(), t


def test_totals_of_contexts_are_products_of_factors():
    """Totals equal the sums of exponentials, in blocks, pair by pair and beyond the range of the factors."""
    rng = np.random.default_rng(4)
    for scale, limit in ((1.0, 1e-5), (400.0, 1e-2)):
        m = B.LogBilinear(rng.integers(1, 99, 60), 8)
        m.r, m.q = m.r * np.float32(10 * scale), m.q * np.float32(10)
        one, two = rng.integers(0, 61, 900), rng.integers(0, 61, 900)
        logit = m.predicted(one, two).astype(float) @ m.q.T.astype(float) + m.b
        top = logit.max(1)
        right = top + np.log(np.exp(logit - top[:, None]).sum(1))
        for how in ({}, {"held": 4 * 60 * 7}, {"wide": 5, "dense": 0}, {"held": 1, "wide": 1}):
            assert np.abs(m.log_totals(one, two, **how) - right).max() < limit


def test_vectorised_counting_helpers_match_plain_python():
    from collections import Counter
    from lanegraph.llm import exchange as X
    from lanegraph.llm.lbl import _sums
    from lanegraph.llm.shingles import _MULT, _powers, word_hashes
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 7, 64, 1000):
        assert _powers(n, _MULT).tolist() == [pow(_MULT, i, 1 << 64) for i in range(n)]
    for texts in ([b""], [b"", b"", b"one"], [b"a b", b"", b"c", b" d\t\ne ", b"", b" "], [b"ab", b"cd ab", b"", b"ab "],
                  [bytes(rng.choice(list(b"ab \n"), m)) for m in rng.integers(0, 9, 200)]):
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        h, row, start, end = word_hashes(data, offsets)
        words = [(i, w) for i, t in enumerate(texts) for w in t.split()]
        whole = b"".join(texts)
        assert [(i, whole[a:b]) for i, a, b in zip(row, start, end)] == words
        assert len(set(h.tolist())) == len({w for _, w in words})
    values = rng.integers(0, 40, 300).astype(np.uint64)
    assert X.distinct(values).tolist() == sorted(set(values.tolist())) and not len(X.distinct(values[:0]))
    parts = [np.unique(values[i:i + 100], return_counts=True) for i in (0, 100, 200)] + [(values[:0], np.zeros(0, np.int64))]
    keys, counts = X.merge_sorted(parts)
    assert dict(zip(keys.tolist(), counts.tolist())) == Counter(values.tolist()) and (np.diff(keys.astype(int)) > 0).all()
    for width in (50, 1 << 16, (1 << 16) + 1):
        x, v = rng.integers(max(0, width - 50), width, 400).astype(np.int32), rng.random((400, 3), np.float32)
        right = np.zeros((width, 3))
        np.add.at(right, x, v)
        assert np.abs(_sums(x, v, width) - right).max() < 1e-4
