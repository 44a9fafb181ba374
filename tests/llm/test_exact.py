"""Exact dedup and secret scan against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from lanegraph.llm import secrets as S
from lanegraph.llm.exact_dedup import drop_exact_copies, exact_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(t):
    return hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()


def test_exact_groups(edge, empty):
    docs, rows = edge
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha(t)].append(i)
    got = exact_groups(docs).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert r.group_size == len(ids) and r.keep_id == best
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == best
    assert set(kept.values()) == {1}                     # one row each, repeated rows too
    assert exact_groups(empty).count() == 0
    assert drop_exact_copies(empty).count() == 0
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns and sorted(sha(r.text) for r in out.collect()) == sorted(groups)


def test_hot_digest_is_settled_map_side(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(
        F.concat(F.lit("t"), (F.col("id") % 1500).cast("string"))).alias("text"))
    got = exact_groups(docs, top=100, counters=128)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[0].group_size == 1667 and rows[0].keep_id == 4998 and sum(r.kept for r in rows.values() if r.group_size == 1667) == 1
    assert len(rows) == 5000


PATTERNS = [(re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
            (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32)]


def base(t):
    found = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(PATTERNS) for m in p.finditer(t) if len(m[g]) >= n]
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans(spark, edge, empty):
    texts = ["TOKEN=secret : abcdefghij AKIA1234567890ABCDE", None, "", "é😀 password='hunter22222' x", "tok: ab3", "secret=abc",
             "deadbeef" * 9 + " " + "a" * 40, "api_key: token=" + "f" * 33, "ſecret=abcdefghij Key apikey=\"ABCDEFGHIJ.k", "AKIA" * 5,
             "token" + " " * 3000 + "= " + "Z" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in S.digest_columns(S.scan(docs)).collect()}
    for i, t in enumerate(texts):
        want = base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, got[i], want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(want.count(k + ":") for k in S.KINDS[:3])
    assert S.digest_columns(S.scan(edge[0])).count() == len(edge[1])
    assert S.scan(empty).count() == 0 and S.redact(empty).columns == empty.columns
    assert [r.text for r in S.redact(docs).where("doc_id in (3, 6, 1)").orderBy("doc_id").collect()] == [
        None, "é😀 [SECRET]' x", "[SECRET] [SECRET]"]


def test_markov_spans(spark):
    rnd = random.Random(5)
    alphabet = S.ALPHABET
    words = ["connection", "handler", "request", "buffer", "default", "manager", "session", "register", "version2", "index10"]
    samples = [("".join(rnd.choice(alphabet) for _ in range(40)), True) for _ in range(300)]
    samples += [("_".join(rnd.choice(words) for _ in range(3)), False) for _ in range(600)] + [(None, True), ("", False)]
    llr = S.train(spark.createDataFrame(samples, "sample string, random boolean"))
    secret = "".join(rnd.choice(alphabet) for _ in range(36)) + "7a"
    name = "connection_handler_version2_manager"
    docs = spark.createDataFrame([(1, f"use {name} with {secret} please"), (2, name)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in S.scan(docs, llr=llr).collect()}
    assert [(s.start, s.end, s.kind) for s in got[1]] == [(len(f"use {name} with "), len(f"use {name} with {secret}"), 3)]
    assert got[2] == []
