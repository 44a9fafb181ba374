"""Secret scan: base patterns plus character Markov models (built-in functions only).

Base kinds are the three patterns below.  A fourth kind, ``markov``, adds
runs of key characters that two first-order character models tell apart: one
of random strings, trained on the values the base patterns found, one of
ordinary identifiers, trained on words of the corpus.  A run is reported when
its log-likelihood ratio per character transition passes a threshold.

Spark has no function that returns every match position, so positions come
from ``split``: the pieces between matches alternate with the matches
themselves, and running lengths (in code points) give the offsets.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_of

# The patterns of the base kinds.  Hex and access keys are
# written with their minimum length: a maximal run that is long enough matches
# whole, a shorter one has no long part, so nothing else changes.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

#: Characters of the models; all others end a run.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]{7,}"


def matches(text: Column, pattern: str, kind: int, group: int = 0, min_chars: int = 0) -> Column:
    """Array of struct(start, end, kind, value) of the leftmost non-overlapping
    matches whose ``group`` has ``min_chars`` characters or more."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>").alias("out"))

    def step(acc, x):
        at = acc["at"] + F.length(x["gap"])
        end = at + F.length(x["hit"])
        hit = F.struct(at.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        keep = x["hit"].isNotNull() & (F.length(x["value"]) >= min_chars)
        return F.struct(F.coalesce(end, at).alias("at"),
                        F.when(keep, F.concat(acc["out"], F.array(hit))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")
    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans of one text, ordered by start, then kind."""
    return F.array_sort(F.concat(matches(text, ASSIGN, 0, group=2, min_chars=8), matches(text, ACCESS, 1),
                                 matches(text, HEX, 2)))


def labelled_samples(docs: DataFrame, text_col: str = "text", max_identifier_docs: int = 4000) -> DataFrame:
    """(sample, random) rows to train on: values that the base patterns find
    in *all* texts are random strings; identifiers come from a bounded hash
    sample of about ``max_identifier_docs`` documents, whose base matches of all
    three kinds are cut out first: a base value is never an identifier."""
    text = text_of(docs, text_col)
    total = docs.count()
    share = max(1, total // max_identifier_docs)
    found = docs.select(F.explode(base_spans(text)).alias("s")).select(
        F.regexp_extract("s.value", r"[A-Za-z0-9+/_-]+", 0).alias("sample"), F.lit(True).alias("random"))
    rest = text
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    ids = (docs.where(F.pmod(F.xxhash64(text), F.lit(share)) == 0)
           .select(F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("sample"), F.lit(False).alias("random")))
    return found.unionByName(ids)


def train(samples: DataFrame, prior: float = 0.5, backoff: float = 4.0) -> list[float]:
    """Log-likelihood ratios, random against identifier, of every pair of
    ASCII characters as a flat 128×128 table.

    ``samples``: (sample string, random boolean); nulls are skipped.  Counts
    are Spark aggregates; what reaches the driver is at most two rows per pair
    of alphabet characters, whatever the input.  ``prior`` is added to every
    character's count, and each row of pairs is drawn towards the characters'
    shares with the weight of ``backoff`` pairs; an untrained model is uniform.
    """
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("sample") - 1),
                                 lambda i: F.substring(F.col("sample"), i, F.lit(2))))
    counts = (samples.where(F.length("sample") > 1).select("random", pair.alias("pair"))
              .where(F.col("pair").rlike("^[A-Za-z0-9+/_-]{2}$"))
              .groupBy("random", "pair").agg(F.count("*").alias("n")).collect())
    table = {(r["random"], r["pair"]): r["n"] for r in counts}
    size = len(ALPHABET)
    p = {}
    for lab in (True, False):
        seen = {b: sum(table.get((lab, a + b), 0) for a in ALPHABET) for b in ALPHABET}
        total = sum(seen.values())
        share = {b: (seen[b] + prior) / (total + prior * size) for b in ALPHABET}     # for rows never seen
        for a in ALPHABET:
            row = sum(table.get((lab, a + b), 0) for b in ALPHABET)
            for b in ALPHABET:
                p[lab, a, b] = (table.get((lab, a + b), 0) + backoff * share[b]) / (row + backoff)
    llr = [0.0] * (128 * 128)
    for a in ALPHABET:
        for b in ALPHABET:
            llr[ord(a) * 128 + ord(b)] = math.log(p[True, a, b] / p[False, a, b])
    return llr


def mean_ratio(run: Column, llr: list[float]) -> Column:
    """Log-likelihood ratio per transition of a run of alphabet characters."""
    table = F.from_json(F.lit(json.dumps(llr)), "array<double>")
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c))
    walked = F.aggregate(codes, F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last")), lambda acc, c: F.struct(
        F.when(acc["last"] < 0, acc["sum"]).otherwise(acc["sum"] + F.get(table, acc["last"] * 128 + c)).alias("sum"),
        c.alias("last")), lambda acc: acc["sum"])
    return walked / (F.length(run) - 1)


def markov_spans(text: Column, base: Column, llr: list[float], threshold: float) -> Column:
    """Runs of 20 or more alphabet characters holding a digit and a letter,
    clear of every base span, whose mean ratio is at least ``threshold``."""
    runs = matches(text, RUN, 3)
    return F.filter(runs, lambda r: r["value"].rlike("[0-9]") & r["value"].rlike("[A-Za-z]")
                    & ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
                    & (mean_ratio(r["value"], llr) >= threshold))


def scan(docs: DataFrame, llr: list[float] | None = None, text_col: str = "text", out: str = "spans",
         threshold: float = 0.7, max_identifier_docs: int = 4000) -> DataFrame:
    """``docs`` plus an array column ``out`` of struct(start, end, kind, value).

    Offsets count code points, end exclusive; ``kind`` indexes ``KINDS``; order
    is by start, then kind.  Null text counts as empty and has no span.  The
    models are trained from the documents themselves unless ``llr`` is given.
    """
    llr = llr or train(labelled_samples(docs, text_col, max_identifier_docs))
    base = fresh(docs, "_base")
    text = text_of(docs, text_col)
    with_base = docs.withColumn(base, base_spans(text))
    both = F.concat(F.col(base), markov_spans(text, F.col(base), llr, threshold))
    return with_base.withColumn(out, F.array_sort(both)).drop(base)


def digest_columns(found: DataFrame, id_col: str = "doc_id", spans: str = "spans") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of a scan."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    s = F.col(spans)

    def of(kind: int) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [of(k) for k in range(4)]
    return found.select(F.col(id_col).alias("doc_id"), *counts,
                        F.sha2(joined(F.filter(s, lambda x: x["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
                        joined(s).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; texts without a span are
    untouched (null stays null); a column ``n_chars`` follows the new text."""
    spans = fresh(docs, "_spans")
    found = scan(docs, text_col=text_col, out=spans, **options)
    text = found[text_col]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        cut = F.greatest(acc["at"], s["start"])
        piece = F.substring(text, acc["at"] + 1, cut - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.when(s["start"] < acc["at"], F.lit("")).otherwise(
                F.concat(piece, F.lit(mark)))).alias("out")))

    clean = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.greatest(F.length(text) - acc["at"], F.lit(0)))))
    hit = F.size(spans) > 0
    out = found.withColumn(text_col, F.when(hit, clean).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length(text_col).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
