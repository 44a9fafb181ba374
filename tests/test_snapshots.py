"""Versioned marts: pinned readers, lost races, failed writes, expiry."""

import pytest
from pyspark.sql import functions as F

from lanegraph.sinks import snapshots as N


def test_versions_pin_readers(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "marts")
    assert N.read_marts_or_none(spark, folder, ["a", "b"]) == {"a": None, "b": None}
    with pytest.raises(N.NoSnapshot):
        N.open_snapshot(spark, folder)
    a1 = spark.createDataFrame([(1, "x"), (2, None)], "k long, s string")
    b1 = spark.range(3)
    assert N.commit_tables({"a": a1, "b": b1}, folder, partition_by={"a": ["s"]}) == 1
    reader = N.open_snapshot(spark, folder)
    held = reader["a"]
    assert sorted(r.k for r in held.collect()) == [1, 2] and held.where("s is null").first().k == 2

    # a reader during a rewrite keeps its version, a new one sees the next; b is carried over
    assert N.commit_tables({"a": spark.createDataFrame([(9, "y")], "k long, s string")}, folder) == 2
    assert sorted(r.k for r in held.collect()) == [1, 2] and sorted(r.k for r in reader["a"].collect()) == [1, 2]
    now = N.open_snapshot(spark, folder)
    assert (now.version, list(now), now["a"].first().k, now["b"].count()) == (2, ["a", "b"], 9, 3)
    marts = N.read_marts_or_none(spark, folder, ["b", "none"])
    assert marts["b"].count() == 3 and marts["none"] is None and N.open_snapshot(spark, folder, 1)["a"].count() == 2

    # a write that fails on its second table commits nothing
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        N.commit_tables({"a": a1, "bad": bad}, folder)
    assert N.versions(spark, folder) == [1, 2]

    # a writer that saw an old list loses the number, and keeps what the winner wrote
    real, calls = N.versions, []

    def stale(s, f):
        calls.append(1)
        return real(s, f)[:-1] if len(calls) == 1 else real(s, f)

    monkeypatch.setattr(N, "versions", stale)
    assert N.commit_tables({"c": spark.range(5)}, folder) == 3 and len(calls) == 2
    monkeypatch.undo()
    assert list(N.open_snapshot(spark, folder)) == ["a", "b", "c"] and N.open_snapshot(spark, folder)["a"].first().k == 9

    # expiry: young files stay, then only what the kept version names
    assert len(list((tmp_path / "marts" / "data").iterdir())) == 4
    assert N.expire(spark, folder, keep=2) == [1] and len(list((tmp_path / "marts" / "data").iterdir())) == 4
    assert N.expire(spark, folder, keep=1, min_age=0.0) == [2]
    assert len(list((tmp_path / "marts" / "data").iterdir())) == 3         # the failed write is gone
    assert {k: v.count() for k, v in N.open_snapshot(spark, folder).items()} == {"a": 1, "b": 3, "c": 5}
    with pytest.raises(N.NoSnapshot):
        N.open_snapshot(spark, folder, 1)
    assert N.commit_tables({"d": b1}, folder, inherit=False) == 4 and list(N.open_snapshot(spark, folder)) == ["d"]
