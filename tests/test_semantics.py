"""Micro-fixtures for the cleaning, banding and aggregation rules."""

from pyspark.sql import functions as F

from lanegraph.functions.bands import delay_band
from lanegraph.functions.facility import facility_type, facility_type_from_name, parse_facility
from lanegraph.operators import aggregate as A
from lanegraph.operators import decision as D
from lanegraph.operators.clean import backfill_names


def test_bands(spark):
    df = spark.createDataFrame([(0.0,), (1.3,), (1.31,), (2.0,), (3.0,), (3.1,), (None,)], "r double")
    got = [r[0] for r in df.select(delay_band("r")).collect()]
    assert got == [None, "Healthy", "Moderate", "Moderate", "Severe", "Critical", None]


def test_parse_facility(spark):
    names = ["Gurgaon_Bilaspur_HB (Haryana)", "Khambhat_MotvdDPP_D (Gujarat)", "Surat_HUB (Gujarat)", "", None,
             "NoParens_DC"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    rows = df.select(*[v.alias(k) for k, v in parse_facility(F.col("name"), "").items()]).collect()
    assert (rows[0].city, rows[0].state, rows[0].facility_type) == ("Gurgaon", "Haryana", "HB")
    assert rows[1].facility_type == "D"  # the last part decides (documented behaviour)
    assert rows[2].facility_type == "H"  # "HUB" matches no suffix; the "_H" fallback applies
    assert (rows[3].city, rows[3].state, rows[3].facility_type) == (None, None, None)
    assert (rows[4].city, rows[4].state) == (None, None)
    assert (rows[5].state, rows[5].facility_type) == (None, "DC")
    t = [r[0] for r in df.select(facility_type_from_name("name")).collect()]
    assert t[0] == "HB" and t[4] == "Unknown"


def test_mode_tie_and_single_row_std(spark):
    legs = spark.createDataFrame(
        [("a", "b", "t1", 1.0, 10.0, 1.0, 1.0, "b"), ("a", "b", "t2", 2.0, 10.0, 1.0, 1.0, "a"),
         ("a", "b", "t3", 3.0, 10.0, 1.0, 1.0, "b"), ("a", "b", "t4", 4.0, 10.0, 1.0, 1.0, "a"),
         ("x", "y", "t5", 1.6, 5.0, 1.0, 1.0, "b")],
        "source_center string, destination_center string, trip_uuid string, factor double, actual_time double,"
        " osrm_time double, osrm_distance double, route_type string")
    c = {(r.source_center): r for r in A.corridor_stats(legs).collect()}
    assert c["a"].primary_route_type == "a"
    assert c["x"].delay_ratio_std is None and c["x"].corridor_reliability == 1.0
    assert abs(c["a"].delay_ratio_median - 2.5) < 1e-12
    assert abs(c["a"].sla_breach_pct - 0.75) < 1e-12  # 2, 3, 4 exceed 1.5


def test_null_factor_counts_as_not_late(spark):
    legs = spark.createDataFrame([("a", "b", "t", None, 1.0), ("a", "b", "t", 1.5, 1.0), ("a", "b", "t", 1.6, 1.0)],
                                 "source_center string, destination_center string, trip_uuid string, factor double,"
                                 " actual_time double")
    legs = legs.withColumns({"osrm_time": F.lit(1.0), "osrm_distance": F.lit(1.0), "route_type": F.lit("FTL")})
    r = A.corridor_stats(legs).first()
    assert abs(r.sla_breach_pct - 1 / 3) < 1e-12


def test_backfill_keeps_unknown_null(spark):
    df = spark.createDataFrame(
        [("t1", 1, "c1", None, "d1", "D1"), ("t1", 2, "c1", "Name1", "d1", None), ("t2", 1, "c2", None, "d2", None)],
        "trip_uuid string, seg_no long, source_center string, source_name string, destination_center string,"
        " destination_name string")
    got = {(r.trip_uuid, r.seg_no): r for r in backfill_names(df).collect()}
    assert got[("t1", 1)].source_name == "Name1"
    assert got[("t2", 1)].source_name is None
    assert got[("t1", 2)].destination_name == "D1"


def test_eval_metrics(spark):
    df = spark.createDataFrame([("m", 100.0, 110.0), ("m", 0.0, 5.0), ("m", None, 7.0)],
                               "model string, y double, y_pred double")
    r = D.eval_metrics(df).first()
    assert r.MAE == 7.5 and r.MAPE == 10.0 and r.Acc_10 == 100.0


def test_facility_type_rule_order(spark):
    df = spark.createDataFrame([("A_B_H (S)",), ("A_BDC (S)",)], "n string")
    assert [r[0] for r in df.select(facility_type("n")).collect()] == ["H", "DC"]


def test_names_are_parsed_once_or_inline_with_equal_rows(spark):
    from lanegraph.operators.clean import clean_data, names_seen, parse_names
    rows = [("t1", 1, "a", "Surat_HUB_H (Gujarat)", "b", None, -1.0, 0.0, 2.0), ("t1", 2, "b", "Pune_DC (Maharashtra)", None, "", 3.0, 1.0, 0.0),
            ("t2", 1, None, "Agra", "a", None, 1.0, 1.0, 1.0), ("t2", 2, "b", "Later_H (Goa)", "a", "Surat_HUB_H (Gujarat)", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "trip_uuid string, seg_no int, source_center string, source_name string, destination_center string,"
                                     "destination_name string, segment_actual_time double, segment_osrm_time double, segment_osrm_distance double")
    seen = names_seen(df)
    once, inline = parse_names(df, seen), parse_names(df, seen, limit=0)
    assert once.columns == inline.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, inline.collect()))
    got = {(r.trip_uuid, r.seg_no): r for r in clean_data(df).collect()}
    assert got["t1", 1].source_state == "Gujarat" and got["t1", 1].segment_actual_time == 0.0 and got["t1", 1].segment_osrm_time is None
    assert got["t1", 1].destination_name is None          # known as a source only: roles don't mix
    assert got["t2", 1].destination_name == "Surat_HUB_H (Gujarat)" and got["t2", 1].dest_state is None      # parsed before back-fill
    assert got["t1", 2].destination_name == "" and got["t1", 2].dest_facility_type is None
    assert clean_data(df.limit(0)).count() == 0


def test_network_tables_equal_the_wide_aggregates(spark):
    from lanegraph.operators.graph import core as G
    rows = [(None if k % 31 == 0 else f"t{k % 17}", k, f"F{k % 4}" if k % 9 else None, f"S{k % 4}_HB (X)" if k % 5 else None,
             f"F{k % 3}" if k % 11 else None, f"D{k % 3}_H (X)" if k % 4 else None, None if k % 13 == 0 else ("FTL", "Carting")[k % 2],
             float(k % 23), float(k % 7), float(k % 29), None if k % 8 == 0 else (k % 19) / 5) for k in range(300)] * 2
    legs = spark.createDataFrame(rows, "trip_uuid string, seg_no long, source_center string, source_name string, destination_center string, "
                                       "destination_name string, route_type string, actual_time double, osrm_time double, osrm_distance double, factor double")
    show = lambda df, keys: [[round(x, 9) if isinstance(x, float) else x for x in r] for r in df.orderBy(*keys).collect()]
    mine, wide = G.facility_graph(*A.network_tables(legs)), G.facility_graph(A.facility_stats(legs), A.corridor_stats(legs))
    assert show(mine[0], ["id"]) == show(wide[0], ["id"]) and len(show(mine[0], ["id"])) == 4
    assert show(mine[1], ["src", "dst"]) == show(wide[1], ["src", "dst"])
    plan = mine[0]._jdf.queryExecution().toString()
    assert "facility_id" in plan and "Scan ExistingRDD" not in plan          # built from the one written pass


def test_large_tables_are_dealt_by_trip(spark, tmp_path, monkeypatch):
    from lanegraph.sources import segments as S
    src = str(tmp_path)
    n = spark.range(900, numPartitions=3)
    tables = {"lineitem": n.selectExpr("id div 4 l_orderkey", "id % 300 l_partkey", "id % 6 l_suppkey", "id % 4 l_linenumber", "double(id % 40 + 1) l_quantity",
                                       "double(id) l_extendedprice", "(id % 9) / 100d l_discount", "if(id % 2 = 0, 'O', 'F') l_linestatus",
                                       "timestamp_ntz'2020-01-01' l_shipdate"),
              "orders": spark.range(225).selectExpr("id o_orderkey", "id % 10 o_custkey", "timestamp_ntz'2020-01-01' o_orderdate", "'1-URGENT' o_orderpriority"),
              "supplier": spark.range(6).selectExpr("id s_suppkey", "id % 5 s_nationkey"), "customer": spark.range(10).selectExpr("id c_custkey", "id % 5 c_nationkey")}
    for name, df in tables.items():
        df.write.parquet(f"{src}/{name}.parquet")
    before = sorted(map(str, S.legs_from_tables(spark, src).collect()))
    monkeypatch.setattr(S, "ROWS_PER_TASK", 30)
    legs = S.legs_from_tables(spark, src)
    assert sorted(map(str, legs.collect())) == before and len(before) == 900 and legs.rdd.getNumPartitions() == 30
    per = legs.groupBy("trip_uuid", "source_center").count()
    plan = per._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(trip_uuid") == 1 and "hashpartitioning(trip_uuid#" in plan
