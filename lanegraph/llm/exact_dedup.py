"""Exact deduplication with a heavy-hitter split (built-in functions only).

1. One pass over the texts writes a narrow table (id, digest, row number).
2. A frequent-items sketch in the Misra-Gries family (``approx_top_k``: a
   bounded set of counters, all of them decremented when the set overflows,
   merged map-side) names the digests that may hold a fixed share of the rows.
3. Those candidates are verified exactly: their true count and winner.
4. The verified winners, at most ``top`` rows, are broadcast: every row of a
   frequent digest is settled where it lies, no hot key is ever shuffled.
5. Rows of all other digests, each with a bounded share, are settled by one
   ordinary shuffle on the digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from .common import ascii_lower, fresh, text_of


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = 1000,
                 counters: int = 8192, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  The row with the largest id of a group is kept; a null id is
    smaller than any other.  Of repeated rows that tie at the largest id
    exactly one is kept.  An empty table gives no rows; other columns of
    ``docs`` are ignored.

    ``top``: most digests that are treated as frequent, and the bound of the
    broadcast.  ``counters``: size of the sketch; every digest holding more
    than about 1/``counters`` of the rows is seen by it.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    rows = scratch.write(docs.select(
        docs[id_col].alias("doc_id"), F.sha2(ascii_lower(text_of(docs, text_col)).cast("binary"), 256).alias("sha"),
    ).withColumn("rid", F.monotonically_increasing_id()), "digests")

    best = F.max(F.struct("doc_id", "rid")).alias("best")
    frequent = (rows.agg(F.expr(f"approx_top_k(sha, {top}, {counters})").alias("items"), F.count("*").alias("n"))
                .select(F.explode("items").alias("it"), "n")
                .where(F.col("it.count") * top > F.col("n")).where(F.col("it.count") > 1)
                .select(F.col("it.item").alias("sha")))
    frequent = scratch.write(frequent, "frequent")          # at most `top` rows
    winners = scratch.write(rows.join(F.broadcast(frequent), "sha").groupBy("sha")
                            .agg(best, F.count("*").alias("group_size")), "winners")
    hot = rows.join(F.broadcast(winners), "sha")
    same = Window.partitionBy("sha")
    rest = (rows.join(F.broadcast(winners), "sha", "left_anti")
            .select("sha", "doc_id", "rid", F.max(F.struct("doc_id", "rid")).over(same).alias("best"),
                    F.count("*").over(same).alias("group_size")))
    cols = ["doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
            (F.col("rid") == F.col("best.rid")).alias("kept"), F.col("sha").alias("text_sha256")]
    return hot.select(*cols).unionByName(rest.select(*cols))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns kept.

    The kept (id, digest) pairs are joined back null-safely; a row that is
    repeated whole is reduced to one by a row number over the join's own
    partitioning, so no further shuffle is needed.
    """
    rid, sha, row = (fresh(docs, c) for c in ("_id", "_sha", "_row"))
    kept = (exact_groups(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias(rid), F.col("text_sha256").alias(sha + "_k")))
    keyed = docs.withColumn(sha, F.sha2(ascii_lower(text_of(docs, text_col)).cast("binary"), 256))
    out = keyed.join(kept, keyed[id_col].eqNullSafe(kept[rid]) & (keyed[sha] == kept[sha + "_k"]), "left_semi")
    first = F.row_number().over(Window.partitionBy(id_col, sha).orderBy(F.lit(1)))
    return out.withColumn(row, first).where(F.col(row) == 1).select(*docs.columns)
