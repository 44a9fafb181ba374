import os
import sys

import pytest

CLASH = ["sha", "rid", "shard", "bucket", "key", "kept", "n", "row", "block", "bin", "spans", "held", "tkey", "band", "_base", "_id",
         "_key", "_sha", "_row", "_low", "_letters", "letters", "largest", "refers", "a", "b", "component", "root"]


@pytest.fixture(scope="session")
def edge(spark):
    """(docs, rows): null and empty texts, null and repeated ids, repeated
    rows, a very long text, letters beyond ASCII, and clashing extra columns."""
    long = " ".join(f"word{i % 997} other{i % 89}" for i in range(60_000))
    rows = [(1, "Alpha beta gamma delta epsilon zeta eta theta"), (2, "ALPHA beta gamma delta epsilon zeta eta theta"), (3, None),
            (4, ""), (5, " \n\t "), (6, "é😀 Ünïcode straße"), (6, "é😀 Ünïcode straße"), (7, long), (8, long), (9, long + " tail"),
            (None, "Alpha beta gamma delta epsilon zeta eta theta"), (None, None), (10, "x"), (11, "12 34 !!"), (12, "A\x00B ▁ c")]
    data = [(i, t, "en" if t else None, *["z"] * len(CLASH)) for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASH))
    return docs.repartition(3).cache(), rows


@pytest.fixture(scope="session")
def empty(spark, edge):
    return spark.createDataFrame([], edge[0].schema)


sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
