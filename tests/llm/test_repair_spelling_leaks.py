"""Conversation repair, spelling variants and decontamination against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from lanegraph.llm import conversation_repair as R
from lanegraph.llm import decontaminate as D
from lanegraph.llm import spelling as S

from .conftest import CLASH

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ conversation repair

def plain_cheapest(initials, faults):
    """Least (cost, audit) by recursion over (rows read, roles said so far), three inserts in a row at most."""
    @lru_cache(None)
    def rest(i, state, inserts):
        found = []
        if i == len(initials) and state in ("", "a"):
            found.append((0, ""))
        due = "a" if state == "u" else "u"
        if inserts < 3:
            c, s = rest(i, due, inserts + 1)
            found.append((c + 3, "I" + s))
        if i < len(initials):
            c, s = rest(i + 1, state, 0)
            found.append((c + 4, "D" + s))
            if faults[i] in (R.FINE, R.TRUNCATED):
                extra = 3 * (faults[i] == R.TRUNCATED)
                if initials[i] == due or (initials[i] == "s" and state == ""):
                    c, s = rest(i + 1, initials[i], 0)
                    found.append((c + extra, "K" + s))
                c, s = rest(i + 1, due, 0)
                found.append((c + extra + 3, "R" + s))
        return min(found, default=(10 ** 6, ""))
    return rest(0, "", 0)


def test_cheapest_edits_are_cheapest_and_least():
    rng = random.Random(4)
    for k in range(600):
        n = rng.randrange(0, 12)
        ini = "".join(rng.choice("suuaax") for _ in range(n))
        faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        want = plain_cheapest(ini, faults)
        for segment in (1, 2, 5, 256):
            assert R.cheapest(ini, faults, segment) == want, (ini, faults, segment)
    for ini in map("".join, itertools.product("sua", repeat=4)):
        assert R.cheapest(ini, bytes(4)) == plain_cheapest(ini, bytes(4))


def test_long_conversation_in_segments():
    rng = random.Random(9)
    ini = "".join(rng.choice("uuaas") for _ in range(3000))
    faults = bytes(rng.choice([0, 0, 0, 1, 3]) for _ in range(3000))
    assert R.cheapest(ini, faults) == R.cheapest(ini, faults, 37) == R.cheapest(ini, faults, 1000)
    cost, audit = R.cheapest(ini, faults)
    assert sum(e != "I" for e in audit) == 3000 and cost > 0


def plain_report(rows):
    """Report of one conversation from its (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(R.BLANK if not body else R.DUPLICATE if (role, text) in seen else R.TRUNCATED if body[-1] not in ".!?" else R.FINE)
        seen.add((role, text))
    ini = "".join(r[1][0] if r[1][:1] in ("s", "u", "a") and r[1] else "x" for r in rows)
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = plain_cheapest(ini, bytes(faults))
    out, i, due = [], 0, "user"
    first = sum(e != "D" for e in audit) % 2
    for e in audit:
        if e != "I":
            _, role, text = rows[i]
            i += 1
        if e == "D":
            continue
        if first:
            first = 0
            out.append(f"{role}:{text}")
            continue
        out.append(f"{role if e == 'K' else due}:{'' if e == 'I' else text}")
        due = "assistant" if due == "user" else "user"
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(2), faults.count(3), faults.count(1),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), out


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out[conv] += [(turn, "user" if k == 4 else role, text)] * (1 + (k == 3))
    return out


def test_reports_equal_plain_python(spark):
    rng = random.Random(2)
    texts = ["Hello there.", "And you?", "no end", "", None, " \n\t", "é😀!", "So. ", "a" * 200_000 + ".", "x", " ", "Hello there."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in [*range(rng.randrange(0, 8)), *rng.choices([None, 3, 3, 40, -5], k=rng.randrange(3))]:
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]), rng.choice(texts)))
    rows += [(7, 2, "user", "Hello there.")] * 3 + [(100, None, None, None), (101, 2 ** 63 - 1, "user", "a."), (101, -2 ** 62, "assistant", "b.")]
    data = [(*r, *["z"] * len(CLASH)) for r in rows]
    conv = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASH)).repartition(4)
    hurt = plain_damage(rows)
    wrap = lambda x: (x + 2 ** 63) % 2 ** 64 - 2 ** 63
    got = {r.conv_id: tuple(r)[1:] for r in R.reports(R.damage(conv)).collect()}
    want = {c: plain_report(x) for c, x in hurt.items()}
    assert set(got) == set(want)
    for c, (w, _) in want.items():
        assert got[c] == (wrap(w[0]), *w[1:]), c
    gone = [c for c, x in hurt.items() if not x]
    assert all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    out = defaultdict(list)
    for r in R.repaired(R.damage(conv), segment=2).orderBy("conv_id", "place").collect():
        out[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.place == len(out[r.conv_id]) - 1
    assert {c: x for c, (_, x) in want.items() if x} == out
    empty = conv.where(F.lit(False))
    assert R.reports(R.damage(empty)).count() == 0 and R.repaired(R.as_rows(empty)).count() == 0


def test_hot_conversation_is_streamed(spark):
    n = 20_000
    conv = spark.range(n).select(F.lit("hot").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("row "), F.col("id").cast("string"), F.when(F.col("id") % 5 == 0, "").otherwise(".")).alias("text"))
    r = R.reports(R.as_rows(conv)).first()
    assert (r.gaps, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (0, 0, n // 5, 0, 3 * n // 5, "K" * n)


# ------------------------------------------------------------------ spelling variants

def plain_words(rows, least=7, every=31):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return n


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, ratio=10):
    form, out = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(near), None if form[w] is None else counts[form[w]])
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


@pytest.mark.parametrize("limit", [1, 6, 4096])
def test_near_words_equal_brute_force(spark, limit):
    rng = random.Random(3)
    words = set()
    while len(words) < 700:
        words.add("".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 9, 10]))))
    words |= {"a" * k for k in range(7, 14)} | {"é" * k for k in range(7, 10)} | {"x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149}
    counts = {w: rng.choice([2, 3, 5, 30, 70, 700, 9000]) for w in words}
    got = S.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), limit=limit).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain_variants(counts) and len(got) == len(counts)


def test_words_of_texts(spark, edge, empty):
    docs, rows = edge
    got = {r.word: r.n for r in S.word_counts(docs, least=4, every=3, min_count=1).collect()}
    assert got == plain_words(rows, 4, 3)
    rng = random.Random(8)
    texts = [(i, " ".join("".join(rng.choice("aZÉéß×ñ1-Ā") for _ in range(rng.randrange(1, 20))) for _ in range(rng.randrange(200)))) for i in range(50)]
    texts += [(60, "q" * 5000 + " " + "Ünterschied" * 30), (61, "abcdefg"), (61, "abcdefg"), (62, None), (63, "")]
    more = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    for every in (1, 2, 31):
        assert {r.word: r.n for r in S.word_counts(more, every=every, min_count=1).collect()} == plain_words(texts, 7, every)
    counts = {w: n for w, n in plain_words(texts).items() if n >= 2}
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.spelling_variants(more).collect()} == plain_variants(counts)
    assert S.spelling_variants(empty).count() == 0
    assert set(S.spelling_variants(docs).columns) == {"word", "form", "root", "n", "n_near", "form_n"}


# ------------------------------------------------------------------ decontamination

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall((t or "").translate(LOWER))


def plain_hits(rows, items, window=10):
    windows = defaultdict(set)
    for i, t in items:
        ws = split(t)
        size = min(len(ws), window)
        for k in range(len(ws) - size + 1 if ws else 0):
            windows[tuple(ws[k:k + size])].add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        ws, hit, found = split(t), set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                ids = windows.get(tuple(ws[k:k + size]))
                if ids:
                    hit |= set(range(k, k + size))
                    found |= ids
        out.append((i, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("bits", [6, 27])
def test_contamination_equals_brute_force(spark, edge, empty, bits):
    rng = random.Random(1)
    vocabulary = ["the", "a", "of", "Zwölf", "x1", "7", "straße", "日本"]
    say = lambda n, k=8: [rng.choice(vocabulary[:k]) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([0, 3, 9, 10, 11, 25]), rng.choice([1, 2, 8])))) for i in range(40)]
    items += [(None, "the quick brown fox"), (None, None), (7, "only - seven, words here: in this."), (50, " ".join(say(3000)))]
    rows = []
    for i in range(150):
        ws = say(rng.randrange(60), rng.choice([1, 2, 8]))
        for _ in range(rng.randrange(3)):
            t = split(rng.choice(items)[1])
            a = rng.randrange(max(1, len(t) - 5))
            k = rng.randrange(len(ws) + 1)
            ws[k:k] = t[a:a + rng.choice([8, 9, 10, 11, 30])]
        rows.append((i, rng.choice([" ", ". ", "\n", "_"]).join(w.upper() if rng.random() < 0.2 and w.isascii() else w for w in ws)))
    rows += [(200, items[-1][1]), (200, items[-1][1]), (201, None), (None, "The QUICK brown fox!"), (202, ""), (203, "fox " * 30_000 + "the quick brown fox")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in D.contamination(docs, bench, max_filter_bits=bits).collect())
    assert got == plain_hits(rows, items)
    own, plain = edge
    clashing = own.withColumn("item_id", F.col("doc_id").cast("string"))
    assert Counter(tuple(r) for r in D.contamination(own, clashing, max_filter_bits=bits).collect()) == plain_hits(plain, plain)
    assert D.contamination(empty, bench).count() == 0
    none = D.contamination(docs, bench.where(F.lit(False)))
    assert none.count() == len(rows) and none.where("contaminated or n_hit > 0 or n_items > 0").count() == 0
