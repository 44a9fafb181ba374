"""Reader, timestamp parsing and every writer, as round trips on files."""

import datetime as dt

from pyspark.sql import functions as F

from lanegraph.schema import RAW_SEGMENT
from lanegraph.sinks import store as K
from lanegraph.sources import segments as SG


def _row(**over):
    base = {f.name: None for f in RAW_SEGMENT.fields}
    base |= {"data": "training", "trip_uuid": "t1", "route_type": "FTL", "source_center": "a", "destination_center": "b",
             "trip_creation_time": "2018-09-20 02:35:36.476840", "od_start_time": "2018-12-31 23:59:59", "cutoff_timestamp": "bad", "factor": "1.5"}
    return base | over


def test_reader_and_timestamps(spark, tmp_path):
    names = [f.name for f in RAW_SEGMENT.fields]
    rows = [_row(), _row(trip_uuid="t2", factor="NaN", od_end_time="2018-09-21 00:00:00", source_name="Surat_HUB (Gujarat)", data="test")]
    text = ",".join(names) + "\n" + "\n".join(",".join("" if r[n] is None else str(r[n]) for n in names) for r in rows) + "\n"
    (tmp_path / "raw.csv").write_text(text)
    df = SG.load_and_prepare(spark, str(tmp_path / "raw.csv"))
    got = {r["trip_uuid"]: r for r in df.collect()}
    assert got["t1"]["trip_creation_time"] == dt.datetime(2018, 9, 20, 2, 35, 36, 476840)
    assert got["t1"]["cutoff_timestamp"] is None and got["t1"]["od_end_time"] is None
    assert got["t1"]["factor"] == 1.5 and got["t2"]["factor"] is None
    assert got["t2"]["source_name"] == "Surat_HUB (Gujarat)" and got["t1"]["source_name"] is None
    train, test = SG.split_train_test(df)
    assert (train.count(), test.count()) == (1, 1)
    prof = {r["column"]: r for r in SG.profile_datetimes(SG.scan_segments(spark, str(tmp_path / "raw.csv"))).collect()}
    assert prof["cutoff_timestamp"]["parsed"] == 0 and prof["trip_creation_time"]["pct_valid"] == 100.0 and prof["od_end_time"]["pct_valid"] == 50.0


def test_tables_summary_and_graph(spark, tmp_path):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 2.5)], "k long, s string, d double")
    v = spark.createDataFrame([("p",), ("q",)], "id string")
    e = spark.createDataFrame([("q", "p", 1.0), ("p", "q", 2.0)], "src string, dst string, weight double")
    K.write_tables({"a": a, "parts": a}, str(tmp_path / "m"), partition_by={"parts": ["s"]})
    marts = K.read_marts(spark, str(tmp_path / "m"))
    assert set(marts) == {"a", "parts"} and marts["a"].schema == a.schema
    assert sorted(map(tuple, marts["parts"].select("k", "s", "d").collect())) == [(1, "x", None), (2, "y", 2.5)]
    assert (tmp_path / "m" / "parts" / "s=x").is_dir()
    K.write_summary_json(a.where("k = 1"), str(tmp_path / "s"))
    assert K.read_summary_json(spark, str(tmp_path / "s")) == {"k": 1, "s": "x", "d": None}
    K.write_graph(v, e, str(tmp_path / "g"))
    v2, e2 = K.read_graph(spark, str(tmp_path / "g"))
    assert {r.id for r in v2.collect()} == {"p", "q"} and e2.agg(F.sum("weight")).first()[0] == 3.0


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    K.write_model(model, str(tmp_path / "lr"))
    back = K.read_model(str(tmp_path / "lr")).transform(df)
    assert back.where(F.abs(F.col("prediction") - F.col("y")) > 1e-6).count() == 0


def test_quantiles_are_exact(spark):
    import random

    import numpy as np

    from lanegraph.operators.quantiles import exact_quantiles
    random.seed(5)
    rows = [(g, random.choice([1.0, 2.0, 5.5, None, random.random() * 100])) for g in ("a", "b") for _ in range(300)] + [("c", 4.0), ("d", None)]
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, x double").repartition(4), ["g"], "x", {"q1": 0.25, "m": 0.5, "p9": 0.9}).collect()}
    for g in ("a", "b", "c"):
        v = [x for k, x in rows if k == g and x is not None]
        assert np.allclose([got[g].q1, got[g].m, got[g].p9], np.quantile(v, [0.25, 0.5, 0.9]))
    assert "d" not in got
