"""Bands, scenarios, encodings, cleaning and impact scores on a few rows."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lanegraph.functions.bands import severity_band
from lanegraph.operators import clean as C
from lanegraph.operators import decision as D
from lanegraph.operators import features as FE
from lanegraph.operators import ml as ML
from lanegraph.operators.graph import stats as S


def test_severity_and_recommendation(spark):
    df = spark.createDataFrame([(80.0,), (70.0,), (41.0,), (40.0,), (None,)], "x double")
    assert [r[0] for r in df.select(severity_band("x", 70, 40)).collect()] == ["High", "Medium", "Medium", "Low", "Low"]
    m = spark.createDataFrame([(0.0,), (2.9,), (3.0,), (40.0,)], "m double")
    assert [r[0] for r in m.select(D.scenario_recommendation(F.col("m"))).collect()] == ["deploy", "approve", "consider_others", "consider_others"]


def test_scenarios_add_up(spark):
    hubs = spark.createDataFrame([("h", 50.0, 1000.0)], "facility_id string, impact_score_normalized double, throughput double")
    rows = {r.action: r for r in D.hub_scenarios(hubs).collect()}
    assert len(rows) == len(D.UPGRADE_ACTIONS)
    for name, cut, capex, _ in D.UPGRADE_ACTIONS:
        r = rows[name]
        annual = 1000 * 0.18 * cut * 25 * 365 / 100000
        assert math.isclose(r.annual_recovery_lakh, annual) and math.isclose(r.net_first_year_lakh, annual - capex)
        assert math.isclose(r.breaches_prevented, 1000 * 0.18 * cut) and math.isclose(r.projected_delay, 75.0 * (1 - cut))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_backfill_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(C, "BROADCAST_NAMES", limit)
    rows = [("t1", 1, "a", None, "b", "B1"), ("t1", 2, "a", "A1", "c", None), ("t2", 1, "a", "A2", "b", None), ("t3", 1, "z", None, None, None)]
    df = spark.createDataFrame(rows, "trip_uuid string, seg_no long, source_center string, source_name string, destination_center string, destination_name string")
    got = {(r.trip_uuid, r.seg_no): (r.source_name, r.destination_name) for r in C.backfill_names(df).collect()}
    assert got == {("t1", 1): ("A1", "B1"), ("t1", 2): ("A1", None), ("t2", 1): ("A2", "B1"), ("t3", 1): (None, None)}


def test_encodings_use_training_trips_only(spark):
    cols = "trip_uuid string, source_center string, destination_center string, source_facility_type string, dest_facility_type string, source_state string, dest_state string, source_city string, dest_city string, actual_time double"
    train = spark.createDataFrame([("1", "a", "b", "HB", "DC", "S1", "S2", "x", "y", 10.0), ("2", "a", "c", "DC", None, "S1", "S1", "x", "x", 30.0)], cols)
    new = spark.createDataFrame([("3", "a", "q", "GW", "DC", "S1", None, "x", "y", 99.0)], cols)
    r = FE.encode_trips(FE.spatial_features(new), train).first()
    assert r.source_center_encoded == 20.0 and r.destination_center_encoded == 20.0       # unseen: the training mean
    assert r.source_facility_type_encoded == -1 and r.dest_facility_type_encoded == 0 and r.source_state_encoded == 0
    assert r.dest_state_encoded == -1 and r.facility_type_pair_encoded == -1
    assert "cutoff_factor" in FE.LEAKY_COLS


def test_impact_and_core(spark):
    v = spark.createDataFrame([("a", "A", "HB", 100, 2.0, 0.5), ("b", None, "DC", None, None, None)],
                              "id string, name string, type string, throughput long, avg_delay double, sla_breach_pct double")
    cent = spark.createDataFrame([("a", 0.2, 0.6), ("b", 0.0, 0.4)], "id string, betweenness double, pagerank double")
    got = {r.facility_id: r for r in S.impact_scores(v, cent).collect()}
    assert math.isclose(got["a"].impact_score, (0.06 + 0.12) * (0.5 + 0.075 + math.log(101) * 0.1))
    assert got["a"].impact_score_normalized == 100.0 and got["b"].impact_score == 0.0
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("d", "a")], "src string, dst string")
    nodes = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    cv, ce = S.core_subgraph(nodes, e, keep=3)
    assert {r.id for r in cv.collect()} == {"a", "b", "c"} and {(r.src, r.dst) for r in ce.collect()} == {("a", "b"), ("a", "c"), ("b", "c")}


def test_boosting_runs_all_rounds_on_all_rows(spark, monkeypatch):
    rows = [(f"t{i}", float(i % 7), float(i % 11), 50.0, "FTL" if i % 2 else "Carting") for i in range(80)]   # no gain after few rounds
    trips = spark.createDataFrame(rows, "trip_uuid string, osrm_time double, osrm_distance double, actual_time double, route_type string").coalesce(1)
    fitted = []
    fit = ML.fit
    monkeypatch.setattr(ML, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    monkeypatch.setitem(ML.BOOSTERS, "gbt", replace(ML.BOOSTERS["gbt"], rounds=12, depth=2))
    monkeypatch.setitem(ML.BOOSTERS, "residual_gbt", replace(ML.BOOSTERS["residual_gbt"], rounds=200, depth=3))
    monkeypatch.setitem(ML.BOOSTERS, "classifier", replace(ML.BOOSTERS["classifier"], rounds=12, depth=2))
    cols = ["osrm_time", "osrm_distance"]
    assert ML.gbt_eta(trips, trips, cols).count() == 80
    ML.route_type_classifier(trips, trips, cols).collect()
    for model in fitted:
        assert len(model.trees.roots) == 12
    report = ML.gbt_eta(trips, trips.withColumn("actual_time", F.lit(1.0)), cols, "residual_gbt", "r", True)
    assert abs(report.where("trip_uuid = 't3'").first().y_pred - 50) < 1
