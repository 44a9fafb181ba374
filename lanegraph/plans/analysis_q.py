"""Registered queries: features, delay/SLA, decision metrics and dashboard marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import estimated_sla, rule_route_recommendation
from ..operators import aggregate as A
from ..operators import decision as D
from ..operators import delay as DL
from ..operators import features as FE
from ..operators import marts as M
from ..operators.graph.core import cut
from .registry import above_ties, clean_legs, finish, legs, query

TEMPORAL = ["creation_hour", "creation_day_of_week", "creation_is_weekend", "creation_is_peak",
            "creation_is_night", "creation_day_of_month", "creation_week_of_year", "start_hour", "start_is_peak"]
CYCLIC = ["creation_hour_sin", "creation_hour_cos", "creation_dow_sin", "creation_dow_cos"]
ROUTE = ["is_ftl", "osrm_speed_kmh", "log_osrm_time", "log_osrm_distance", "log_num_segments",
         "log_segment_osrm_time_sum", "log_segment_osrm_distance_sum", "avg_segment_distance", "avg_segment_time"]


def trips(spark, sf_dir):
    return A.agg_trips(clean_legs(spark, sf_dir))


def train_corridors(spark, sf_dir, with_medians=True):
    return A.corridor_stats(legs(spark, sf_dir).where(F.col("data") == "training"), with_medians=with_medians)


def corridor_table(spark, sf_dir):
    """The training corridors, written once for queries that read them twice."""
    return cut(train_corridors(spark, sf_dir, with_medians=False))


def features(spark, sf_dir):
    return FE.trip_features(trips(spark, sf_dir))


# ---------------------------------------------------------------------- features

@query("temporal_features")
def _temporal(spark, sf_dir):
    return FE.temporal_features(trips(spark, sf_dir)).select("trip_uuid", *TEMPORAL)


@query("cyclic_encoding")
def _cyclic(spark, sf_dir):
    t = FE.cyclic_encoding(FE.temporal_features(trips(spark, sf_dir)))
    return finish(t.select("trip_uuid", *CYCLIC))


@query("time_since_creation")
def _tsc(spark, sf_dir):
    return finish(FE.time_since_creation(trips(spark, sf_dir)).select("trip_uuid", "time_since_creation_min"))


@query("route_features")
def _route(spark, sf_dir):
    return finish(FE.route_features(trips(spark, sf_dir)).select("trip_uuid", *ROUTE))


@query("trip_speed")
def _speed(spark, sf_dir):
    return finish(A.trip_speed(trips(spark, sf_dir)))


@query("spatial_features")
def _spatial(spark, sf_dir):
    return FE.spatial_features(trips(spark, sf_dir)).select("trip_uuid", "is_same_city", "facility_type_pair")


@query("label_encode")
def _label(spark, sf_dir):
    return features(spark, sf_dir).select(
        "trip_uuid", "source_facility_type_encoded", "dest_facility_type_encoded", "source_state_encoded",
        "dest_state_encoded", "facility_type_pair_encoded")


@query("target_encode")
def _target(spark, sf_dir):
    return finish(features(spark, sf_dir).select("trip_uuid", "source_center_encoded",
                                                 "destination_center_encoded"))


@query("impute_matrix")
def _impute(spark, sf_dir):
    return finish(FE.impute_matrix(features(spark, sf_dir)).select("trip_uuid", "data", *FE.FEATURE_COLS))


# ------------------------------------------------------------------------- delay

@query("classify_corridors")
def _classify(spark, sf_dir):
    return finish(DL.classify_corridors(train_corridors(spark, sf_dir, False))
                  .select("source_center", "destination_center", "delay_ratio_mean", "delay_class"))


@query("delay_distribution")
def _dist(spark, sf_dir):
    return finish(DL.delay_distribution(train_corridors(spark, sf_dir, False)))


@query("delay_summary")
def _summary(spark, sf_dir):
    return finish(DL.delay_summary(train_corridors(spark, sf_dir, False)))


@query("top_delayed_corridors")
def _top_delayed(spark, sf_dir):
    # rank on the presented (rounded) ratio so float noise cannot reorder ties
    c = finish(train_corridors(spark, sf_dir, False)
               .select("source_center", "destination_center", "delay_ratio_mean", "trip_count"))
    return DL.top_delayed_corridors(c)


@query("sla_totals")
def _sla_totals(spark, sf_dir):
    return DL.sla_totals(train_corridors(spark, sf_dir, False))


@query("sla_contribution")
def _sla_contrib(spark, sf_dir):
    return finish(DL.sla_contribution(corridor_table(spark, sf_dir)))


@query("run_delay_analysis")
def _run_delay(spark, sf_dir):
    r = DL.run_delay_analysis(corridor_table(spark, sf_dir))
    return finish(A.one_row_join(r["summary"], r["sla_totals"].drop("total_corridors")))


# ---------------------------------------------------------------------- decision

@query("corridor_impact")
def _impact(spark, sf_dir):
    return finish(A.corridor_impact(corridor_table(spark, sf_dir))
                  .select("source_center", "destination_center", "corridor_impact"))


@query("corridor_severity")
def _corr_sev(spark, sf_dir):
    c = finish(A.corridor_impact(corridor_table(spark, sf_dir)).select("source_center", "destination_center", "corridor_impact"))
    return D.corridor_severity(c)


@query("top_bottleneck_corridors")
def _top_corr(spark, sf_dir):
    c = finish(A.corridor_impact(corridor_table(spark, sf_dir))
               .select("source_center", "destination_center", "corridor_impact", "delay_ratio_mean",
                       "sla_breach_pct", "trip_count"))
    return c.orderBy(F.desc("corridor_impact"), "source_center", "destination_center").limit(15)


def _planned_preds(spark, sf_dir):
    t = trips(spark, sf_dir).where(F.col("data") == "test")
    return t.select(F.lit("planned_time").alias("model"), F.col("actual_time").alias("y"),
                    F.col("osrm_time").alias("y_pred"), F.col("osrm_time").alias("osrm"))


@query("planned_time_baseline")
def _planned(spark, sf_dir):
    return D.eval_metrics(_planned_preds(spark, sf_dir))


@query("business_metrics")
def _business(spark, sf_dir):
    return finish(D.business_metrics(_planned_preds(spark, sf_dir)))


@query("upgrade_scenarios")
def _scenarios(spark, sf_dir):
    return finish(above_ties(D.corridor_scenarios(train_corridors(spark, sf_dir, False)), "net_first_year_lakh", "annual_recovery_lakh"))


@query("rule_route_recommendation")
def _rule(spark, sf_dir):
    c = A.corridor_impact(train_corridors(spark, sf_dir, False))
    return finish(c.select("source_center", "destination_center", "osrm_distance_mean",
                           rule_route_recommendation(F.round("osrm_distance_mean", 9)).alias("recommendation"),
                           estimated_sla(F.round("corridor_impact", 9)).alias("estimated_sla")))


# ------------------------------------------------------------------------- marts

@query("route_type_performance")
def _rtp(spark, sf_dir):
    return finish(M.route_type_performance(trips(spark, sf_dir)))


@query("route_type_share")
def _rts(spark, sf_dir):
    return finish(M.route_type_share(trips(spark, sf_dir)))


@query("corridor_eta_quantiles")
def _etaq(spark, sf_dir):
    return finish(M.corridor_eta_quantiles(trips(spark, sf_dir)))


@query("source_eta_fallback")
def _etaf(spark, sf_dir):
    return finish(M.source_eta_fallback(trips(spark, sf_dir)))


@query("histograms")
def _hist(spark, sf_dir):
    t = cut(trips(spark, sf_dir))
    tr = legs(spark, sf_dir).where(F.col("data") == "training")
    c = cut(A.corridor_stats(tr, with_medians=False))
    h1 = M.histogram(t, F.col("actual_time"), 30, "trip_time")
    h2 = M.histogram(c, F.least(F.col("delay_ratio_mean"), F.lit(10.0)), 50, "delay_ratio")
    h3 = M.histogram(t.where(F.col("route_type") == "FTL"), F.least(F.col("actual_time"), F.lit(2000.0)), 30,
                     "ftl_time")
    h4 = M.histogram(t.where(F.col("route_type") == "Carting"), F.least(F.col("actual_time"), F.lit(2000.0)), 30,
                     "carting_time")
    return finish(h1.unionByName(h2).unionByName(h3).unionByName(h4))


@query("facility_selectors")
def _selectors(spark, sf_dir):
    return M.facility_selectors(trips(spark, sf_dir))


@query("corridor_trip_lookup")
def _lookup(spark, sf_dir):
    t = cut(trips(spark, sf_dir))
    key = M.busiest_corridor(t)
    sel = t.join(F.broadcast(key), ["source_center", "destination_center"])  # key is one row
    bound = sel.agg(F.greatest(F.max("actual_time"), F.max("osrm_time")).alias("axis_max"))
    return finish(A.one_row_join(sel.select("source_center", "destination_center", "trip_uuid",
                                            "actual_time", "osrm_time"), bound))


@query("delay_vs_volume")
def _dvv(spark, sf_dir):
    return finish(M.delay_vs_volume(train_corridors(spark, sf_dir, False)))


@query("filter_corridors_by_class")
def _fcc(spark, sf_dir):
    return finish(M.filter_corridors_by_class(train_corridors(spark, sf_dir, False)))


@query("bidirectional_corridors")
def _bidir(spark, sf_dir):
    return M.bidirectional_corridors(train_corridors(spark, sf_dir, False))


@query("corridor_dedup")
def _dedup(spark, sf_dir):
    return M.corridor_dedup(legs(spark, sf_dir))
