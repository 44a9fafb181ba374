"""WARC, near duplicates, repeated strings, search and the pipeline."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lanegraph.llm import minhash as M
from lanegraph.llm import search as Q
from lanegraph.llm import suffix_dedup as S
from lanegraph.llm import warc as W
from lanegraph.llm.shingles import utf8_buffer


# ------------------------------------------------------------------ WARC

def test_warc_round_trip_and_determinism(spark, tmp_path):
    rows = [(1, "http://a/é x", "<p>é</p>"), (2, None, None), (3, "u\r\nv", ""), (4, "u", "same" * 50), (5, "v", "same" * 50), (5, "v", "same" * 50),
            (None, "n", "only"), (9, "w", "x" * 300_000), (10, "w", "y\r\n\r\nz")]
    pages = spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, key string, refers string")
    names = {}
    for run, parts in (("one", 1), ("two", 4)):
        folder = f"file://{tmp_path}/{run}"
        manifest = W.write_warc(pages.repartition(parts), folder, shard_bytes=2000, roll_bytes=500)
        names[run] = sorted((r.name, r.sha256, r.records) for r in manifest.collect())
        got = W.read_warc(spark, folder).collect()
        largest = {}
        for i, _, h in rows:
            largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
        want = []
        for i, _, h in rows:
            b = (h or "").encode()
            top = largest[h or ""]
            ref = None if (i is None and top == -1) or i == top else top
            want.append((str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if ref is None else "revisit", ref))
        key = lambda t: tuple(map(str, t))
        assert sorted(((str(r.record_key), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
        assert not (tmp_path / run / "tmp").exists()
    assert names["one"] == names["two"] and len(names["one"]) > 3        # same bytes however the input lies
    big = W.write_warc(pages, f"file://{tmp_path}/three", min_revisit_bytes=10_000)
    assert {r.record_type for r in W.read_warc(spark, f"file://{tmp_path}/three").collect()} == {"response"} and big.count() >= 1
    W.write_warc(pages.limit(0), f"file://{tmp_path}/four")
    assert W.read_warc(spark, f"file://{tmp_path}/four").count() == 0


def test_warc_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    W.write_warc(pages, f"file://{tmp_path}/w")
    file = next((tmp_path / "w").glob("*.warc.gz"))
    import gzip
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"abc", b"abd")))
    with pytest.raises(Exception, match="digest differs|does not agree|not a WARC"):
        W.read_warc(spark, f"file://{tmp_path}/w").collect()


# ------------------------------------------------------------------ near duplicates

def shingles(t):
    w = [x for x in re.split(r"[ \t\n\x0b\x0c\r]+", (t or "").lower()) if x]
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_signature_agreement_is_weighted_jaccard():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    a = [rng.choice(words) for _ in range(300)]
    b = list(a)
    for i in range(0, 300, 25):
        b[i] = "changed"
    texts = [" ".join(a), " ".join(b), " ".join(a + a[:150]), "one two", " ".join(["x"] * 200)]
    ids, weight, row, sets, border, _ = M.elements(*utf8_buffer(pa.array(texts)))
    sig = M.signatures(ids, weight, row, len(texts), 2000)
    assert (sig != 0).all()
    for i in range(3):
        for j in range(i):
            true = jaccard(shingles(texts[i]), shingles(texts[j]))
            x, y = (sets[border[k]:border[k + 1]] for k in (i, j))
            both = len(np.intersect1d(x, y))
            assert abs(both / (len(x) + len(y) - both) - true) < 1e-9
            assert abs((sig[i] == sig[j]).mean() - true) < 0.05


def test_elements_of_few_short_rows():
    for texts in ([""], ["a"], ["a b", ""], ["", "", "x y z"], ["a b c d e"], [" "]):
        ids, weight, row, sets, border, digest = M.elements(*utf8_buffer(pa.array(texts)))
        assert len(border) == len(texts) + 1 and border[-1] == len(sets) == weight.sum()
        assert [int(border[i + 1] - border[i]) for i in range(len(texts))] == [int(bool(t.split())) for t in texts]
        sig = M.signatures(ids, weight, row, len(texts), 25)
        assert [(s != 0).all() for s in sig] == [bool(t.split()) for t in texts]


def test_near_classes_against_brute_force(spark, edge, empty):
    rng = random.Random(2)
    words = [f"v{i}" for i in range(3000)]
    texts = []
    for g in range(25):
        t = [rng.choice(words) for _ in range(rng.randint(40, 160))]
        texts.append(" ".join(t))
        for _ in range(rng.randint(0, 4)):
            c = list(t)
            for _ in range(rng.randint(1, 3)):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(" ".join(c).upper() if rng.random() < 0.2 else " ".join(c))
    rng.shuffle(texts)
    texts += ["same words here", "Same  words\nhere", "", None, "a b", texts[0]]
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    got = {r.doc_id: r for r in M.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    assert {i: got[i].class_id for i in got} == {i: find(i) for i in range(len(texts))}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values())
    assert all(got[i].class_size == sum(find(j) == find(i) for j in range(len(texts))) for i in got)
    docs, rows = edge
    out = M.near_classes(docs).toPandas()
    assert len(out) == len(rows) and out[out.doc_id.isin([7, 8, 9])].class_id.nunique() == 1
    kept = M.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == int(out.kept.sum())
    assert M.near_classes(empty).count() == 0 and M.drop_near_copies(empty).count() == 0


def brute_classes(texts):
    sets = [set(shingles(t)) for t in texts]                               # no text has a shingle twice
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in range(len(texts))}


def test_near_classes_of_a_large_template(spark, monkeypatch):
    """700 texts at 0.6 to 0.7 to each other with near copies inside, in few
    bands: a further common band isn't asked of a pair."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(160)]
    texts = []
    for i in range(560):
        t = base + [f"own{i}x{n}" for n in range(32)]
        texts.append(" ".join(t))
        if i % 4 == 0:
            cut = [w if n not in (20, 100) else f"c{i}x{n}" for n, w in enumerate(t)]
            texts.append(" ".join(cut))
    rng.shuffle(texts)
    want = brute_classes(texts)
    assert len(set(want.values())) == 560
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for group in (2048, 100):
        monkeypatch.setattr(M, "GROUP", group)
        got = {r.doc_id: r.class_id for r in M.near_classes(docs, bands=3, rows=1).collect()}
        # pairs without a common band can't be found; all others are
        ids, weight, row, _, _, _ = M.elements(*utf8_buffer(pa.array([t.lower() for t in texts])))
        sig = M.signatures(ids, weight.astype(np.int64), row, len(texts), 3)
        partner = {}
        for i, c in want.items():
            partner.setdefault(c, []).append(i)
        for own in partner.values():
            if len(own) == 2 and (sig[own[0]] == sig[own[1]]).any():
                assert got[own[0]] == got[own[1]]
        assert all(want[i] == want[c] for i, c in got.items())


def test_near_classes_of_a_chain(spark):
    """The centre is like the middle text and the middle like the last, which
    the centre isn't: the link to a member of the centre's class counts."""
    for seed in range(50):
        centre = [f"s{seed}w{i}" for i in range(100)]
        middle = [f"m{i}" if i in (20, 40) else w for i, w in enumerate(centre)]
        last = [f"l{i}" if i == 60 else w for i, w in enumerate(middle)]
        texts = [" ".join(t) for t in (last, middle, centre)]
        ids, weight, row, _, _, _ = M.elements(*utf8_buffer(pa.array(texts)))
        if len(set(M.signatures(ids, weight.astype(np.int64), row, 3, 1)[:, 0])) == 1:
            break
    assert jaccard(shingles(texts[0]), shingles(texts[2])) < 0.8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)       # the last row is the centre
    got = {r.doc_id: r.class_id for r in M.near_classes(docs, bands=1, rows=1).collect()}
    assert got == {0: 0, 1: 0, 2: 0} == brute_classes(texts)


# ------------------------------------------------------------------ repeated strings

def plain_cut(rows, length=50):
    top = 2 ** 63 - 1
    docs = [(top if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in docs:
        for i in range(len(b) - length + 1):
            k = b[i:i + length]
            first[k] = min(first.get(k, d), d)
    out = []
    for d, b in docs:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = True
        gone = gone[:len(b)]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def cut(df, **options):
    got = S.remove_repeats(df, **options).collect()
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed
        assert len(r.spans) == r.n_spans
    return sorted((2 ** 63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)


def test_suffix_order_and_windows():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 600).astype(np.uint8)
    text[100:180] = text[300:380]
    size = np.array([250, 250, 100])
    ends = np.repeat(np.cumsum(size), size)
    for depth in (8, 13, 16, 50, 64):
        order, rank, _ = S.suffix_order(text, ends, depth)
        pieces = [text[i:i + depth].tobytes() for i in order]
        assert pieces == sorted(pieces) and len(pieces) == sum(np.maximum(size - depth + 1, 0))
        assert all((x == y) == (rank[i] == rank[j]) for x, y, i, j in zip(pieces, pieces[1:], order, order[1:]))
    pos, group = S.equal_windows(text, ends, 50)
    by = defaultdict(set)
    for p, g in zip(pos, group, strict=True):
        by[g].add(text[p:p + 50].tobytes())
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)
    assert len(pos) == sum(size - 49)


def test_remove_repeats(spark, edge, empty):
    p, q = "abcdefghij" * 8, "The quick brown fox jumps over the lazy dog, and then some more of it. "
    rows = [(1, q), (2, "x" + q + "y"), (3, p), (4, p + q + p), (4, q), (None, q), (None, q + "z"), (7, None), (8, ""), (9, "a" * 49), (10, "a" * 200),
            (11, "a" * 60), (12, q[:50]), (13, q[1:50]), (14, "é" * 30), (15, "éé" * 30 + "b\0\0" + "\0" * 60), (16, "\0" * 55)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"shard_bytes": 200}, {"shard_bytes": 150, "frequent": 2}):
        assert cut(df, **options) == plain_cut(rows), options
    small = [(i, t) for i, t in edge[1] if not t or len(t) < 1000]
    assert cut(edge[0].where("text is null or length(text) < 1000")) == plain_cut(small)
    assert S.remove_repeats(edge[0], with_text=False).count() == len(edge[1])
    assert S.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ search

def test_top_k_against_all_scores(spark, edge, empty):
    rng = random.Random(4)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 80)))) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(15)] + [(400, None), (420, ""), (None, rows[40][1])]
    got = defaultdict(list)
    for r in Q.top_k(spark.createDataFrame(rows, "doc_id long, text string"), shard_bytes=3000).collect():
        got[r.query_id].append((r.rank, r.doc_id, r.score))
    count = {n: Counter(Q.terms(*utf8_buffer(pa.array([t or ""])))[0].tolist()) for n, (_, t) in enumerate(rows)}
    df = Counter(w for c in count.values() for w in c)
    mean = sum(map(lambda c: sum(c.values()), count.values())) / len(rows)
    idf = {w: math.log1p((len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    for n, (i, t) in enumerate(rows):
        if i is None or i % 20 or not t:
            assert i not in got
            continue
        own = {w: idf[w] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * sum(count[n].values()) / mean)) for w, c in count[n].items() if df[w] > 1}
        ask = sorted(own, key=lambda w: (-own[w], w))[:12]
        score = {m: sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in ask if w in c) for m, c in count.items()}
        best = sorted((round(-s, 9), 10 ** 9 if rows[m][0] is None else rows[m][0]) for m, s in score.items() if s > 0)[:10]
        assert [(round(-s, 9), 10 ** 9 if d is None else d) for _, d, s in sorted(got[i])] == best, i
    assert Q.top_k(edge[0], every=2).count() > 0 and Q.top_k(empty).count() == 0


def test_search_asks_with_all_words(spark, tmp_path):
    from lanegraph.llm import registry
    rng = random.Random(5)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120)))) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(15)] + [(400, "alone here"), (420, ""), (None, rows[40][1]), (60, "another text of id sixty")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    count = [Counter((t or "").split()) for _, t in rows]
    df = Counter(w for c in count for w in c)
    mean = sum(sum(c.values()) for c in count) / len(rows)
    idf = {w: math.log1p((len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    want = {}
    for i in {i for i, t in rows if i is not None and i % 20 == 0 and t}:
        ask = {w for (j, _), c in zip(rows, count, strict=True) if i == j for w in c}
        score = [sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in ask if w in c) for c in count]
        want[i] = sorted((round(-s, 9), 10 ** 9 if j is None else j) for (j, _), s in zip(rows, score, strict=True) if s > 0)[:10]
    assert want[400] and want[400][0][1] == 400                            # its words are in no other text
    whole = Q.top_k(spark.read.parquet(f"{tmp_path}/documents.parquet"), n_terms=None, shard_bytes=3000)     # several waves
    for got in (registry.QUERIES["op6_bm25_search"](spark, str(tmp_path)), whole):
        found = defaultdict(list)
        for r in got.collect():
            found[r.query_id].append((round(-r.score, 9), 10 ** 9 if r.doc_id is None else r.doc_id))
        assert {i: sorted(x) for i, x in found.items()} == want


def test_search_by_blocks_of_queries(spark):
    rng = random.Random(6)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120)))) for i in range(200)] + [(300 + i, "same few words") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, blocks = (sorted(map(tuple, Q.top_k(docs, n_terms=None, shard_bytes=9000, **how).collect())) for how in ({}, {"block_terms": 250}))
    assert whole == blocks and len({r[0] for r in whole}) == 12


@pytest.mark.parametrize("head", [0, 3, 128])
def test_long_queries_find_what_adding_up_everything_finds(monkeypatch, head):
    monkeypatch.setattr(Q, "HEAD", head)
    rng = np.random.default_rng(7)
    n_rows, n_terms = 300, 400
    share = 0.9 / (1 + np.arange(n_terms)) ** 0.7
    term, row = np.nonzero(rng.random((n_terms, n_rows)) < share[:, None])
    impact, weight = rng.choice([0.5, 1.0, 1.5, 2.0], len(row)), 0.1 + rng.random(n_terms)
    have = np.flatnonzero(np.bincount(term, minlength=n_terms))
    term, weight = np.searchsorted(have, term), weight[have]
    index = Q.Index(row, impact, np.searchsorted(term, np.arange(len(have) + 1)), weight, Q.Rows(row, term, impact, n_rows, len(have)))
    rank = rng.permutation(n_rows)
    table = np.zeros((len(have), n_rows))
    table[term, row] = impact
    for size in (1, 5, 17, 60, 250):
        asked = rng.choice(len(have), size, replace=False)
        score = (table[asked] * weight[asked][:, None]).sum(0)
        full = [(s, r) for _, _, s, r in sorted((-round(s, 9), rank[r], s, r) for r, s in enumerate(score) if s > 0)][:10]
        for least in (-1.0, full[-1][0], full[0][0] * 0.97, full[0][0] * 1.1):
            got = Q.max_score(np.sort(index.place[asked]), index, 10, rank, least)
            want = [(s, r) for s, r in full if s >= least * (1 - 1e-12)]
            assert [r for _, r in got] == [r for _, r in want] and np.allclose([s for s, _ in got], [s for s, _ in want], rtol=1e-12), (size, least)


def index_of(rng, n_rows, n_terms, steep):
    """(index, table of impacts by term and row, weights) with terms ever rarer."""
    share = 0.9 / (1 + np.arange(n_terms)) ** steep
    term, row = np.nonzero(rng.random((n_terms, n_rows)) < share[:, None])
    impact, weight = rng.choice([0.5, 1.0, 1.5, 2.0], len(row)), 0.1 + rng.random(n_terms)
    have = np.flatnonzero(np.bincount(term, minlength=n_terms))
    term, weight = np.searchsorted(have, term), weight[have]
    table = np.zeros((len(have), n_rows))
    table[term, row] = impact
    rows = Q.Rows(row, term, impact, n_rows, len(have))
    return Q.Index(row, impact, np.searchsorted(term, np.arange(len(have) + 1)), weight, rows), table, weight


@pytest.mark.parametrize("n_rows, column_share, matrix_bytes, pairs", [(300, 1e-3, 1 << 20, 1 << 20), (300, 0.05, 1 << 16, 500), (300, 2.0, 1 << 14, 64), (7, 1e-3, 1 << 20, 9)])
def test_queries_scored_together_find_what_each_finds_alone(monkeypatch, n_rows, column_share, matrix_bytes, pairs):
    for name, value in (("COLUMN_SHARE", column_share), ("MATRIX_BYTES", matrix_bytes), ("PAIRS", pairs)):
        monkeypatch.setattr(Q, name, value)
    rng = np.random.default_rng(8)
    index, table, weight = index_of(rng, n_rows, 400, 0.7)
    rank = rng.permutation(n_rows)
    asked = [np.sort(index.place[rng.choice(len(weight), min(s, len(weight)), replace=False)]) for s in rng.integers(1, 120, 60)]
    border, places = np.append(0, np.cumsum([len(x) for x in asked])), np.concatenate(asked)
    alone = [Q.max_score(x, index, 10, rank) for x in asked]
    least = np.array([(-1.0, x[-1][0], x[0][0] * 0.97, x[0][0] * 1.1)[n % 4] if x else -1.0 for n, x in enumerate(alone)])
    queries = np.flatnonzero(np.arange(60) % 7 != 3)
    got = dict(Q.max_score_together(queries, border, places, index, 10, rank, least))
    assert set(got) <= set(queries.tolist())
    for q in queries.tolist():
        assert got.get(q, []) == Q.max_score(asked[q], index, 10, rank, least[q])


def test_short_queries_skip_blocks_and_find_what_adding_up_everything_finds():
    rng = np.random.default_rng(9)
    for n_rows, k in ((1, 10), (40, 10), (700, 3), (700, 10)):
        index, table, weight = index_of(rng, n_rows, 60, 1.0)
        rank = rng.permutation(n_rows)
        for size in (1, 2, 5, 16):
            asked = np.sort(rng.choice(len(weight), min(size, len(weight)), replace=False))
            score = np.zeros(n_rows)
            for t in asked:
                score += weight[t] * table[t]
            full = [(s, r) for _, _, s, r in sorted((-s, rank[r], s, r) for r, s in enumerate(score) if s > 0)][:k]
            for least in (-1.0, full[-1][0], full[0][0] * 0.97, full[0][0] * 1.1):
                got = Q.block_max_wand([(weight[t], index.postings(t)) for t in asked.tolist()], k, rank, least)
                assert got == [(s, r) for s, r in full if s * (1 + 1e-12) >= least]


def test_routes_are_packed_in_less_than_half():
    rng = np.random.default_rng(10)
    asked = rng.geometric(0.05, 3000)
    query = np.concatenate([20 * np.sort(rng.choice(12000, n, replace=False)) for n in asked])
    weight = rng.choice(rng.random(300), 3000)
    sent = Q._routed(np.arange(3000, dtype=np.uint64), asked, weight, query, 20)
    assert len(sent["query_id"]) < 2 * len(query) and len(sent["asked"]) < 2 * len(asked) and len(sent["weight"]) < 6 * len(weight)
    table = pa.table({c: pa.array([x, Q.X.squeeze_planes(np.zeros(0, np.int64))], pa.binary()) for c, x in sent.items()})
    back = {c: np.concatenate(Q.X.expand_planes(table, c, np.int64)) for c in ("asked", "query_id")}
    assert np.array_equal(back["asked"], asked) and np.array_equal(np.cumsum(back["query_id"]) * 20, query)
    assert np.array_equal(np.concatenate(Q.X.expand(table, "weight", np.float64)), weight)


# ------------------------------------------------------------------ pipeline

def test_pipeline_keeps_what_plain_rules_keep(spark, tmp_path):
    import zlib

    import corpus_pipeline as C
    from tokenizers import Tokenizer
    from lanegraph.llm.registry import word_bpe
    rng = random.Random(6)
    en = [f"{a}{b}" for a in ("the", "ing", "ther", "wh", "st") for b in ("er", "ed", "and", "ion", "ou", "ly")]
    de = [f"{a}{b}" for a in ("sch", "ung", "ein", "ver", "pf") for b in ("lich", "keit", "tz", "gen", "ü", "ich")]
    rows = []
    for i in range(120):
        words = en if i % 2 else de
        rows.append((i, " ".join(rng.choice(words) for _ in range(60)), "en" if i % 2 else "de"))
    secret = "0123456789abcdef" * 3
    rows += [(200, rows[5][1].upper(), "en"), (201, rows[7][1] + " extra", "en"), (202, None, "en"), (203, "123 456", "de"), (204, "", None),
             (205, rows[9][1].replace(" ", "  ") + f" token = {secret}", "en")]
    docs = spark.createDataFrame([(i, t, l, "s", len(t or "")) for i, t, l in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = C.run(spark, str(tmp_path)).toPandas()
    # exact: 200 replaces 5; near: 201 and 205 are copies of 7 and 9, the smallest id stays; no letters: 202, 203, 204
    want = (set(range(120)) - {5}) | {200}
    assert set(got.doc_id) == want
    tok = Tokenizer.from_file(word_bpe())
    text = dict((i, t) for i, t, _ in rows)
    for r in got.itertuples():
        ids = tok.encode(text[r.doc_id], add_special_tokens=False).ids + [1]
        assert (r.piece, r.start, r.length, r.ids_crc32) == (0, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    marked = C.secret_scan(spark, docs, str(tmp_path)).where("doc_id = 205").first()
    assert marked.text.endswith("[SECRET]") and secret not in marked.text and marked.n_chars == len(marked.text)
    assert [n for n, _ in C.STAGES] == ["language_id", "exact_dedup", "near_dedup", "secret_scan", "best_fit_packing"]
    nothing = docs.where(F.lit(False))
    for _, stage in C.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0
