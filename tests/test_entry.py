"""Driver contract smoke test."""

import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert set(E.oracle_sql()) <= set(E.queries())
