"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from .twins import OP11_SQL, OP12_SQL, OP13_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


# ------------------------------------------------------------------ 4: exact dedup

OP4_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


@query("op4_exact_dedup", OP4_SQL)
def op4_exact_dedup(spark, sf_dir):
    from .exact_dedup import exact_groups
    return exact_groups(read_table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 2: secret scan

@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    from .secrets import digest_columns, scan
    return digest_columns(scan(read_table(spark, sf_dir, "documents")))


# ------------------------------------------------------------------ 1: WARC

OP1_SQL = """
WITH t AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS largest FROM t)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5))::INT >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM d
"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..scratch import Scratch
    from .warc import read_warc, write_warc
    scratch = Scratch(spark, "warc")
    folder = scratch.path("archive")
    write_warc(read_table(spark, sf_dir, "pages"), folder, scratch=scratch)
    return read_warc(spark, folder).select(F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")


# ------------------------------------------------------------------ 10: near duplicates

@query("op10_minhash_dedup")
def op10_minhash_dedup(spark, sf_dir):
    from .minhash import near_classes
    return near_classes(read_table(spark, sf_dir, "documents")).drop("tkey")


# ------------------------------------------------------------------ 3: packing

def word_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark, sf_dir):
    from .packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"), word_bpe())


# ------------------------------------------------------------------ 7: language identification

@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    from .langid import identify
    return identify(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


# ------------------------------------------------------------------ 9: SentencePiece

@query("op9_sentencepiece")
def op9_sentencepiece(spark, sf_dir):
    import public_tokenizers
    from .sentencepiece_codec import encode
    docs = read_table(spark, sf_dir, "documents")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False).drop("ids")


# ------------------------------------------------------------------ 8: language-model scoring

@query("op8_lm_scoring")
def op8_lm_scoring(spark, sf_dir):
    from .lbl import score
    return score(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


# ------------------------------------------------------------------ 5: repeated strings

@query("op5_suffix_dedup")
def op5_suffix_dedup(spark, sf_dir):
    from .suffix_dedup import remove_repeats
    return remove_repeats(read_table(spark, sf_dir, "documents"), with_text=False).drop("spans", "kept")


# ------------------------------------------------------------------ 6: search

@query("op6_bm25_search")
def op6_bm25_search(spark, sf_dir):
    from .search import top_k
    return top_k(read_table(spark, sf_dir, "documents"), n_terms=None)


# ------------------------------------------------------------------ 11: conversation repair

@query("op11_conversation_repair", OP11_SQL)
def op11_conversation_repair(spark, sf_dir):
    from .conversation_repair import damage, reports
    return reports(damage(read_table(spark, sf_dir, "conversations")))


# ------------------------------------------------------------------ 12: spelling variants

@query("op12_spelling_variants", OP12_SQL)
def op12_spelling_variants(spark, sf_dir):
    from .spelling import spelling_variants
    return spelling_variants(read_table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 13: decontamination

@query("op13_decontamination", OP13_SQL)
def op13_decontamination(spark, sf_dir):
    from .decontaminate import contamination
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
