"""Language identification by multilingual mixture inference.

Languages are distributions over hashed letter trigrams, counted over all
training texts.  A text is a mixture of languages: expectation-maximisation
estimates its proportions, and the set of languages is chosen by penalised
likelihood, growing from the strongest one as long as another language gains
more than the penalty.  The empty set stands for the uniform distribution: a
text that languages explain worse than chance, and of which chance takes most
in a mixture with them, has no language (a key within a sentence doesn't do that).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches, text_of
from .shingles import chunks, trimmed, utf8_buffer

BITS = 15
GRAMS = 1 << BITS


def id_remainder(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, count) of the distinct trigrams of every row.

    Letters are ASCII letters and all bytes from 128; anything between them is
    one blank, and a row begins and ends with a blank.
    """
    n = len(offsets) - 1
    b = np.insert(data, offsets, np.uint8(32))                    # a blank before every row and after the last
    start = offsets + np.arange(n + 1)
    letter = (b >= 128) | ((b | np.uint8(32)) - np.uint8(97) < 26)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:] & ~letter[:-1]
    # of several blanks between two letters the one after the first and the one before the second
    # would both stay: drop the second where the first is not the same byte
    between = keep & ~letter
    twice = np.zeros_like(between)
    at = np.flatnonzero(between)
    if len(at) > 1:
        row_at = np.searchsorted(start, at, "right")
        no_letter = (np.cumsum(letter)[at[1:]] == np.cumsum(letter)[at[:-1]]) & (row_at[1:] == row_at[:-1])
        twice[at[1:][no_letter]] = True
    keep &= ~twice
    pos = np.flatnonzero(keep)
    c = np.where(letter, b, np.uint8(32))[pos].astype(np.uint32)
    row = np.searchsorted(start, pos, "right") - 1
    row = np.minimum(row, n - 1) if n else row
    if len(c) < 3:
        e = np.zeros(0, np.int64)
        return e, e, e
    code = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    # the last blank of a row is the first byte of the next one: the window belongs to the row of its middle
    own = row[1:-1]
    ok = (row[:-2] == own) & ((row[2:] == own) | ((c[2:] == 32) & (row[2:] == own + 1))) & (c[1:-1] != 32)
    gram = (code[ok] * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    key = np.sort((own[ok].astype(np.uint64) << np.uint64(BITS)) | gram)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return ((key[first] >> np.uint64(BITS)).astype(np.int64), (key[first] & np.uint64(GRAMS - 1)).astype(np.int64),
            np.diff(np.append(first, len(key))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8_buffer(batch.column("text"))
        langs = batch.column("lang").dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for i, j in chunks(offsets, 1 << 18):
            row, gram, n = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            lang = code[i:j][row]
            for k in np.unique(lang).tolist():
                own = lang == k
                total.setdefault(names[k], np.zeros(GRAMS, np.int64))
                total[names[k]] += np.bincount(gram[own], weights=n[own], minlength=GRAMS).astype(np.int64)
    for name, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at])],
                                         names=["lang", "gram", "n"])


class Model:
    """Languages and their trigram probabilities (``GRAMS`` × languages)."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", prior: float = 0.5) -> Model:
    """Count trigrams of all rows with a text and a language.  The driver sees
    at most ``GRAMS`` counts per language."""
    small_batches(docs.sparkSession)
    src = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(
        docs[lang_col].cast("string").alias("lang"), F.lower(text_of(docs, text_col)).alias("text"))
    counted = src.mapInArrow(trimmed(_count), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    langs = table.column("lang").to_pylist()
    languages = sorted(set(langs))
    counts = np.zeros((GRAMS, len(languages)))
    at = {x: i for i, x in enumerate(languages)}
    counts[table.column("gram").to_numpy(), [at[x] for x in langs]] = table.column("n").to_numpy()
    p = (counts + prior) / (counts.sum(0) + prior * GRAMS) if languages else counts
    return Model(languages, p)


def mixture(row: np.ndarray, n: np.ndarray, p: np.ndarray, share: np.ndarray, rounds: int = 60,
            tolerance: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of every row by expectation-maximisation.

    ``p``: probability of each (row, gram) under each language; ``share``: the
    start, whose zeros stay zero.  A row rests once no share moves by
    ``tolerance``.
    """
    share = share.copy()
    n_rows = len(share)
    active = np.ones(n_rows, bool)
    total = np.maximum(np.bincount(row, weights=n, minlength=n_rows), 1)
    r, w, q = row, n, p
    for _ in range(rounds):
        mix = share[r] * q
        mix *= (w / mix.sum(1))[:, None]
        new = np.stack([np.bincount(r, weights=mix[:, k], minlength=n_rows) for k in range(q.shape[1])], 1) / total[:, None]
        moved = np.abs(new - share).max(1) >= tolerance
        share[active] = new[active]
        still = active & moved
        if not still.any():
            break
        if still.sum() < active.sum():
            use = still[r]
            r, w, q = r[use], w[use], q[use]
        active = still
    best = np.bincount(row, weights=n * np.log((share[row] * p).sum(1)), minlength=n_rows)
    return share, best


def infer(data: np.ndarray, offsets: np.ndarray, model: Model, penalty: float, noise: float = 0.8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shares of the chosen set, chosen set as booleans, log-likelihood gain
    per trigram over chance) of every row."""
    n_rows, n_lang = len(offsets) - 1, len(model.languages)
    row, gram, n = grams(data, offsets)
    n = n.astype(np.float64)
    p = model.p[gram]
    size = np.bincount(row, weights=n, minlength=n_rows)
    cost = penalty * np.log(np.maximum(size, 2))
    full, ll_full = mixture(row, n, p, np.full((n_rows, n_lang), 1.0 / n_lang))
    order = np.argsort(-full, 1, kind="stable")
    rows = np.arange(n_rows)
    chosen = np.zeros((n_rows, n_lang), bool)
    chosen[rows, order[:, 0]] = True
    share = chosen.astype(float)
    ll = np.bincount(row, weights=n * np.log(p[np.arange(len(row)), order[row, 0]]), minlength=n_rows) if len(row) else np.zeros(n_rows)
    growing = ll_full - ll > cost                  # no larger set can gain more than the full one
    for m in range(1, n_lang):
        if not growing.any():
            break
        tried = chosen.copy()
        tried[rows, order[:, m]] = True
        at = np.flatnonzero(growing)
        back = np.zeros(n_rows, np.int64)
        back[at] = np.arange(len(at))
        use = growing[row]
        start = tried[at] * np.maximum(full[at], 1e-3)
        s, l2 = mixture(back[row[use]], n[use], p[use], start / start.sum(1, keepdims=True))
        gain = l2 - ll[at] > cost[at]
        ok = at[gain]
        chosen[ok], share[ok], ll[ok] = tried[ok], s[gain], l2[gain]
        growing[at[~gain]] = False
    fit = np.where(size > 0, ll / np.maximum(size, 1) + np.log(GRAMS), 0.0)
    # worse than chance as a whole: without a language only if chance also takes most of a mixture with it
    poor = np.flatnonzero(fit <= 0)
    if len(poor):
        back = np.full(n_rows, -1)
        back[poor] = np.arange(len(poor))
        use = back[row] >= 0
        both = np.concatenate([p[use], np.full((int(use.sum()), 1), 1.0 / GRAMS)], 1)
        start = np.concatenate([chosen[poor] / np.maximum(chosen[poor].sum(1, keepdims=True), 1), np.ones((len(poor), 1))], 1) / 2
        mixed, _ = mixture(back[row[use]], n[use], both, start)
        chosen[poor[mixed[:, -1] >= noise]] = False
        chosen[size == 0] = False
    return share, chosen, fit


PREDICTED = "doc_id long, tkey long, lang_pred string, score double, fit double, languages array<string>, shares array<double>"


def _sent(docs: DataFrame, model: Model):
    """Plain values only: a broadcast object would need its class on the executors."""
    return docs.sparkSession.sparkContext.broadcast((model.languages, model.p))


def _predict(model, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*model.value)
        names = np.array(m.languages + ["und"], object)
        for batch in batches:
            data, offsets = utf8_buffer(batch.column("text"))
            known = batch.column("letters").to_numpy(zero_copy_only=False) & bool(m.languages)
            for i, j in chunks(offsets, 1 << 18):
                k = j - i
                ok = known[i:j]
                if m.languages:
                    share, chosen, fit = infer(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], m, penalty)
                else:
                    share, chosen, fit = np.zeros((k, 1)), np.zeros((k, 1), bool), np.zeros(k)
                chosen = chosen & ok[:, None]
                top = np.where(ok, share.argmax(1), len(m.languages))
                score = np.where(ok, share.max(1), 0.0)
                at = [np.flatnonzero(c)[np.argsort(-s[c], kind="stable")] for c, s in zip(chosen, share, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, k), batch.column("tkey").slice(i, k), pa.array(names[top], pa.string()), pa.array(np.clip(score, 0, 1)),
                    pa.array(np.where(ok, fit, 0.0)), pa.array([names[a].tolist() for a in at], pa.list_(pa.string())),
                    pa.array([s[a].tolist() for a, s in zip(at, share, strict=True)], pa.list_(pa.float64()))],
                    names=["doc_id", "tkey", "lang_pred", "score", "fit", "languages", "shares"])
    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 2.0) -> DataFrame:
    """doc_id, lang_pred, score (share of that language), fit (log-likelihood
    per trigram above chance), languages and shares of the chosen set.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned.  Only the text decides.  One row per row of ``docs``; repeated
    rows get equal results, an empty table gives none; other columns are
    ignored.  ``penalty``: of each further language, times log(trigrams).
    """
    small_batches(docs.sparkSession)
    text = text_of(docs, text_col)
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), F.lower(text).alias("text"),
                      text.rlike(r"\p{L}").alias("letters"))
    return src.mapInArrow(trimmed(_predict(_sent(docs, model), penalty)), PREDICTED)


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", mod: int = 4,
             held: int = 2, penalty: float = 2.0) -> DataFrame:
    """``predict`` with a model of the rows whose crc32(id as text) mod ``mod``
    is not ``held``; ``held_out`` tells the others."""
    model = train(docs.where(id_remainder(docs[id_col], mod) != held), lang_col, text_col)
    out = predict(docs, model, id_col, text_col, penalty)
    return out.withColumn("held_out", id_remainder(F.col("doc_id"), mod) == held)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 2.0) -> DataFrame:
    """``docs`` without the rows that have no language: no letter (or a null
    text), or no language set that explains the text better than chance.

    Rows pass through the scan; nothing is shuffled, all columns are kept.
    """
    small_batches(docs.sparkSession)
    low, letters = fresh(docs, "_low"), fresh(docs, "_letters")
    text = text_of(docs, text_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            data, offsets = utf8_buffer(batch.column(low))
            keep = batch.column(letters).to_numpy(zero_copy_only=False).copy()
            for i, j in chunks(offsets, 1 << 18):
                if m.languages:
                    keep[i:j] &= infer(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], m, penalty)[1].any(1)
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    sent = _sent(docs, model)
    return (docs.withColumns({low: F.lower(text), letters: text.rlike(r"\p{L}")}).mapInArrow(trimmed(run), docs.schema).select(*names))
