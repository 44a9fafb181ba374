"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed and its normaliser, metaspace marker, scores (as
merges for a BPE model, as log-probabilities for a unigram model) and byte
fallback are rebuilt as a ``tokenizers.Tokenizer``.  No piece of such a model
has the marker after another character, so a text is encoded run by run, a run
being blanks and what follows them; each distinct run of a task is encoded
once, many runs of a BPE model in one text, and checked against the
sentencepiece library, which takes the runs as lists.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of
from .sentencepiece_model import BPE, BYTE, NORMAL, USER_DEFINED, SentencePieceModel, parse
from .shingles import chunks, trimmed, utf8_buffer
from .tokens import RunMemo, hash_runs, ragged

MARK = "▁"
#: Runs of a BPE model encoded as one text.
JOINED = 200


def merges(model: SentencePieceModel) -> list[tuple[str, str]]:
    """All ways to join two pieces to a third one, best score first."""
    kinds = (NORMAL, USER_DEFINED)
    score = {p: s for p, s, t in zip(model.pieces, model.scores, model.types, strict=True) if t in kinds}
    found = []
    for n, (p, s, t) in enumerate(zip(model.pieces, model.scores, model.types, strict=True)):
        if t in kinds:
            found += [(-s, n, i, (p[:i], p[i:])) for i in range(1, len(p)) if p[:i] in score and p[i:] in score]
    return [pair for *_, pair in sorted(found)]


def build(model: SentencePieceModel, normalise: bool = True):
    """A ``tokenizers.Tokenizer`` equal to the model.  Without ``normalise`` it
    takes text in which blanks are markers already."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers
    vocab = {p: i for i, p in enumerate(model.pieces)}
    unk = model.pieces[model.unk_id]
    if model.model_type == BPE:
        tok = Tokenizer(models.BPE(vocab, merges(model), unk_token=unk, fuse_unk=True, byte_fallback=model.byte_fallback))
    else:
        tok = Tokenizer(models.Unigram(list(zip(model.pieces, model.scores, strict=True)), model.unk_id, model.byte_fallback))
    tok.add_tokens([AddedToken(p, normalized=False) for p, t in zip(model.pieces, model.types, strict=True) if t == USER_DEFINED])
    if normalise:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.add_dummy_prefix:
            steps.append(normalizers.Prepend(MARK if model.escape_whitespaces else " "))
        if model.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        tok.normalizer = normalizers.Sequence(steps)
    strip = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tok


def run_wise(model: SentencePieceModel) -> bool:
    """Whether texts may be encoded run by run: the normaliser only adds the
    prefix and marks blanks, and no piece has a marker behind another character."""
    return (not model.charsmap and model.add_dummy_prefix and not model.remove_extra_whitespaces and model.escape_whitespaces
            and USER_DEFINED not in model.types
            and not any(a != MARK and b == MARK for p, t in zip(model.pieces, model.types, strict=True) if t == NORMAL
                        for a, b in zip(p, p[1:])))


def piece_bytes(model: SentencePieceModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat bytes, begin, size) of what every piece decodes to (blanks for
    markers, one byte for a byte piece)."""
    parts = [bytes([int(p[3:5], 16)]) if t == BYTE else (p.replace(MARK, " ") if t in (NORMAL, USER_DEFINED) else "").encode()
             for p, t in zip(model.pieces, model.types, strict=True)]
    size = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size


def decode(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Bytes of a sequence of ids, the prefix blank still in front."""
    flat, begin, size = table
    n = size[ids]
    total = np.cumsum(n)
    return flat[np.repeat(begin[ids] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]


def blank_runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of blanks and what follows them, see ``tokens.runs``."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e, np.zeros(0, bool), data
    blank = data == 32
    edge = blank.copy()
    edge[1:] &= ~blank[:-1]
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    return hash_runs(data, starts, ends), starts, ends, np.searchsorted(offsets, starts, "right") - 1, np.zeros(len(starts), bool), data


def unequal(codes: np.ndarray, size: np.ndarray, others: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Numbers of the sequences that differ, of two lists of as many."""
    odd = size != other_size
    mine, theirs = np.repeat(~odd, size), np.repeat(~odd, other_size)
    odd[np.repeat(np.arange(len(size)), size)[mine][codes[mine] != others[theirs]]] = True
    return np.flatnonzero(odd)


class Codec:
    """Encoder of Arrow string columns with the parity check of its runs."""

    def __init__(self, model: bytes, verify: bool = True):
        self.model = parse(model)
        self.full, self.raw = build(self.model), build(self.model, normalise=False)
        self.table = piece_bytes(self.model)
        self.fast = run_wise(self.model)
        self.reference = None
        if verify:
            import sentencepiece
            self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.marked = np.array([p.startswith(MARK) for p in self.model.pieces], bool)
        self.blank = np.array([p != "" and not p.strip(MARK) for p in self.model.pieces], bool)
        self.differing: set[int] = set()
        self.memo = RunMemo(self._encode_runs, fine=False, split=blank_runs)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return ragged([e.ids for e in self.raw.encode_batch_fast([t.replace(" ", MARK) for t in texts], add_special_tokens=False)])

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number) of every run.

        Merges of a BPE model never cross the border of two runs, so many runs
        make one text; a run begins at a piece with a marker in front that
        doesn't follow a piece of markers only.  Runs of blanks only would
        merge with the next one and are encoded singly.
        """
        if self.model.model_type != BPE:
            return self._each(texts)
        whole = [n for n, t in enumerate(texts) if t[-1] != " "]
        groups = [whole[k:k + JOINED] for k in range(0, len(whole), JOINED)]
        ids, n_ids = self._each(["".join([texts[n] for n in g]) for g in groups])
        first = self.marked[ids]
        first[1:] &= ~self.blank[ids[:-1]]
        first = np.flatnonzero(first)
        if not np.array_equal(np.diff(np.searchsorted(first, np.append(0, np.cumsum(n_ids)))), list(map(len, groups))):
            return self._each(texts)        # the marker itself isn't a piece
        rest = [n for n, t in enumerate(texts) if t[-1] == " "]
        single, single_size = self._each([texts[n] for n in rest])
        size, begin = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        size[whole], begin[whole] = np.diff(np.append(first, len(ids))), first
        size[rest], begin[rest] = single_size, len(ids) + np.cumsum(single_size) - single_size
        pool, total = np.concatenate([ids, single]), np.cumsum(size)
        return pool[np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0)], size

    def _encode_runs(self, texts: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, size = self._pieces(texts)
        if self.reference is not None:
            # a run begins with a blank: the library's own prefix stands for it, but it gives an empty text none
            lone = [self.reference.piece_to_id(MARK)]
            found = self.reference.encode([t[1:] for t in texts], num_threads=1)
            others = ragged([e if len(t) > 1 else lone for t, e in zip(texts, found, strict=True)])
            self.differing.update((unequal(codes, size, *others) + len(self.memo.begin)).tolist())
        return codes, size

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, borders, parity per row) of a column of texts."""
        data, offsets = utf8_buffer(texts)
        n = len(offsets) - 1
        size = np.diff(offsets)
        odd = np.ones(n, bool)
        if self.fast:
            mark = MARK.encode()
            text = data.tobytes()
            odd = np.fromiter((mark in text[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)), bool, n) \
                if mark in text else np.zeros(n, bool)
        filled = size > 0
        padded = np.insert(data, offsets[:-1][filled], np.uint8(32))
        shifted = offsets + np.append(0, np.cumsum(filled))
        parity = np.ones(n, bool)
        if not odd.any():
            ids, borders, at, row = self.memo.rows(padded, shifted, places=True)
            if self.differing:
                parity[row[np.isin(at, list(self.differing))]] = False
            return ids, borders, parity
        own = [[] for _ in range(n)]
        plain = np.flatnonzero(~odd)
        if len(plain):
            ids, borders, p = self.rows(texts.take(pa.array(plain)))
            for k, i in enumerate(plain.tolist()):
                own[i], parity[i] = ids[borders[k]:borders[k + 1]].tolist(), p[k]
        rest = np.flatnonzero(odd).tolist()
        for i, e in zip(rest, self.full.encode_batch_fast([texts[i].as_py() for i in rest], add_special_tokens=False), strict=True):
            own[i] = e.ids
            parity[i] = self.reference is None or self.reference.encode(texts[i].as_py()) == e.ids
        ids, size = ragged(own)
        return ids, np.append(0, np.cumsum(size)), parity

    def decode_rows(self, ids: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of decoded rows, without the prefix blank."""
        out = decode(ids, self.table)
        ends = np.append(0, np.cumsum(self.table[2][ids]))[borders]
        if self.model.add_dummy_prefix:
            first = ends[:-1][ends[1:] > ends[:-1]]
            first = first[out[first] == 32]
            out = np.delete(out, first)
            ends = ends - np.searchsorted(first, ends, "left")
        return out, ends


ENCODED = "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"


def _encode(model, threads: int, with_ids: bool, verify: bool, group_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        codec = Codec(model.value, verify)
        for batch in batches:
            col = batch.column("text")
            data, offsets = utf8_buffer(col)
            for i, j in chunks(offsets, group_bytes):
                ids, borders, parity = codec.rows(col.slice(i, j - i))
                back, ends = codec.decode_rows(ids, borders)
                own = offsets[i:j + 1] - offsets[i]
                same = np.diff(ends) == np.diff(own)
                if same.all() and np.array_equal(back, data[offsets[i]:offsets[j]]):
                    trip = np.ones(j - i, bool)
                else:
                    trip = np.array([back[a:b].tobytes() == data[offsets[i] + c:offsets[i] + d].tobytes()
                                     for a, b, c, d in zip(ends[:-1], ends[1:], own[:-1], own[1:], strict=True)], bool)
                code = ids.astype("<u4")
                view = memoryview(code.tobytes())
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
                kept = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids.astype(np.int32))) if with_ids \
                    else pa.nulls(j - i, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), kept, pa.array(np.diff(borders)),
                                                  pa.array(crc, pa.int64()), pa.array(parity), pa.array(trip)],
                                                 names=["doc_id", "ids", "n_tokens", "ids_crc32", "parity", "round_trip"])
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", threads: int = 2, with_ids: bool = True,
           verify: bool = True, group_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 (little-endian unsigned 32 bits),
    parity (the sentencepiece library gives the same ids for every run) and
    round_trip (decoding gives the text again).

    ``model`` is a path on the driver; its bytes are sent to the tasks.  Null
    text counts as empty and has no ids; repeated rows are encoded each; an
    empty table gives no rows; other columns are ignored.
    """
    with open(model, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return src.mapInArrow(trimmed(_encode(sent, threads, with_ids, verify, group_bytes)), ENCODED)


def decode_ids(spark: SparkSession, encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids (null or empty ids: empty text; bytes
    that aren't UTF-8 become replacement characters)."""
    with open(model, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(sent.value, verify=False)
        for batch in batches:
            rows = [r or [] for r in batch.column("ids").to_pylist()]
            ids, size = ragged(rows)
            back, ends = codec.decode_rows(ids, np.append(0, np.cumsum(size)))
            raw = back.tobytes()
            text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
