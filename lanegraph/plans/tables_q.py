"""Registered queries: sources, cleaning and the trip/corridor/facility tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.facility import facility_type_from_name, parse_facility, state_from_last_paren
from ..operators import aggregate as A
from ..operators import clean as C
from .registry import above_ties, clean_legs, finish, legs, query


@query("scan_segments")
def _scan(spark, sf_dir):
    return finish(legs(spark, sf_dir))


@query("split_train_test")
def _split(spark, sf_dir):
    return (legs(spark, sf_dir).groupBy("data")
            .agg(F.count("*").alias("segments"), F.count_distinct("trip_uuid").alias("trips")))


@query("sample_rows")
def _sample(spark, sf_dir):
    return finish(legs(spark, sf_dir).orderBy("trip_uuid", "seg_no").limit(1000))


@query("clean_segments")
def _clean(spark, sf_dir):
    return finish(clean_legs(spark, sf_dir).select(
        "trip_uuid", "seg_no", "segment_actual_time", "segment_osrm_time", "segment_osrm_distance",
        "source_name", "destination_name", "source_city", "source_state", "source_facility_type",
        "dest_city", "dest_state", "dest_facility_type", "is_intrastate"))


@query("clean_repair_counts")
def _repairs(spark, sf_dir):
    return C.clean_repair_counts(legs(spark, sf_dir))


@query("backfill_names")
def _backfill(spark, sf_dir):
    return C.backfill_counts(legs(spark, sf_dir))


@query("parse_facility")
def _parse(spark, sf_dir):
    lg = legs(spark, sf_dir)
    names = (lg.select(F.col("source_name").alias("name"))
             .union(lg.select(F.col("destination_name").alias("name")))
             .where(F.col("name").isNotNull()).distinct())
    return names.select("name", *[v.alias(k) for k, v in parse_facility(F.col("name"), "").items()],
                        facility_type_from_name("name").alias("type_by_token"),
                        state_from_last_paren("name").alias("state_last_paren"))


@query("agg_trips")
def _trips(spark, sf_dir):
    return finish(A.agg_trips(clean_legs(spark, sf_dir)))


@query("agg_corridor_stats")
def _corridors(spark, sf_dir):
    return finish(A.corridor_stats(legs(spark, sf_dir).where(F.col("data") == "training")))


@query("agg_facility_stats")
def _facilities(spark, sf_dir):
    return finish(A.facility_stats(legs(spark, sf_dir).where(F.col("data") == "training")))


@query("facility_names")
def _names(spark, sf_dir):
    return A.facility_names(legs(spark, sf_dir))


@query("agg_route_type_corridors")
def _rt(spark, sf_dir):
    rc = A.route_type_corridors(legs(spark, sf_dir).where(F.col("data") == "training"))
    return finish(above_ties(rc, "actual_time", "osrm_time", "distance", "delay_ratio", "weight"))


@query("all_facilities")
def _allf(spark, sf_dir):
    return A.all_facilities(legs(spark, sf_dir))


@query("graph_time_aware")
def _time_aware(spark, sf_dir):
    return finish(A.time_aware_corridors(legs(spark, sf_dir).where(F.col("data") == "training")))


@query("parse_datetimes")
def _parse_times(spark, sf_dir):
    from ..sources.segments import as_text, parse_datetimes
    got = parse_datetimes(as_text(legs(spark, sf_dir)))
    return finish(got.select("trip_uuid", "seg_no", "trip_creation_time", "od_start_time", "od_end_time", "cutoff_timestamp"))


@query("profile_datetimes")
def _profile_times(spark, sf_dir):
    from ..sources.segments import as_text, profile_datetimes
    return finish(profile_datetimes(as_text(legs(spark, sf_dir))))
