"""Dashboard marts: route-type views, ETA quantiles, histograms, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import one_row_join


def route_type_performance(trips: DataFrame) -> DataFrame:
    t = trips.withColumn("is_ftl", F.coalesce(F.col("route_type") == "FTL", F.lit(False)).cast("int"))
    from .quantiles import exact_quantiles
    rest = t.groupBy("is_ftl").agg(
        F.avg("actual_time").alias("actual_time_mean"),
        F.stddev_samp("actual_time").alias("actual_time_std"), F.avg("osrm_time").alias("osrm_time_mean"),
        F.avg("osrm_distance").alias("osrm_distance_mean"), F.avg("num_segments").alias("num_segments_mean"),
        F.count("*").alias("trips"))
    return rest.join(exact_quantiles(t, ["is_ftl"], "actual_time", {"actual_time_median": 0.5}), "is_ftl", "left")


def route_type_share(trips: DataFrame) -> DataFrame:
    ftl = F.coalesce(F.col("route_type") == "FTL", F.lit(False)).cast("double")
    return trips.agg((F.avg(ftl) * 100).alias("ftl_pct"), ((1 - F.avg(ftl)) * 100).alias("carting_pct"))


def corridor_eta_quantiles(trips: DataFrame, min_trips: int = 2) -> DataFrame:
    """Per corridor P10/P50/P90 of trip time; only corridors with > min_trips trips."""
    q = F.percentile("actual_time", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    g = (trips.where(F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())
         .groupBy("source_center", "destination_center")
         .agg(q.alias("_q"), F.avg("actual_time").alias("actual_time_mean"),
              F.avg("osrm_time").alias("osrm_time_mean"), F.avg("osrm_distance").alias("osrm_distance_mean"),
              F.count("*").alias("trips")))
    return (g.where(F.col("trips") > min_trips)
            .select("source_center", "destination_center", F.col("_q")[0].alias("p10"),
                    F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p90"),
                    "actual_time_mean", "osrm_time_mean", "osrm_distance_mean", "trips"))


def source_eta_fallback(trips: DataFrame) -> DataFrame:
    """ETA per corridor from history, else the mean of the source facility."""
    corr = (trips.groupBy("source_center", "destination_center")
            .agg(F.avg("actual_time").alias("_c_actual"), F.avg("osrm_time").alias("_c_osrm")))
    src = (trips.where(F.col("source_center").isNotNull()).groupBy("source_center")
           .agg(F.avg("actual_time").alias("_s_actual"), F.avg("osrm_time").alias("_s_osrm")))
    # observed pairs get their own history; a per-source row is the default for unseen destinations
    out = (corr.where(F.col("source_center").isNotNull()).join(src, "source_center", "left")
           .select("source_center", "destination_center",
                   F.coalesce("_c_actual", "_s_actual").alias("eta_actual"),
                   F.coalesce("_c_osrm", "_s_osrm").alias("eta_planned"),
                   F.lit("corridor").alias("basis")))
    default = src.select("source_center", F.lit(None).cast("string").alias("destination_center"),
                         F.col("_s_actual").alias("eta_actual"), F.col("_s_osrm").alias("eta_planned"),
                         F.lit("source").alias("basis"))
    return out.unionByName(default)


def histogram(df: DataFrame, col: Column, bins: int, label: str = "value") -> DataFrame:
    """Equal-width bins between min and max, last bin closed (numpy rule)."""
    v = df.select(col.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    mm = v.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return (one_row_join(v, mm).withColumn("bin", b)
            .groupBy("bin").agg(F.count("*").alias("count"), F.first("_lo").alias("_lo"),
                                F.first("_hi").alias("_hi"))
            .select(F.lit(label).alias("histogram"), "bin",
                    (F.col("_lo") + (F.col("_hi") - F.col("_lo")) / bins * F.col("bin")).alias("bin_start"),
                    "count"))


def facility_selectors(trips: DataFrame) -> DataFrame:
    s = trips.select(F.lit("source").alias("role"), F.col("source_center").alias("facility_id"))
    d = trips.select(F.lit("destination").alias("role"), F.col("destination_center").alias("facility_id"))
    return s.union(d).where(F.col("facility_id").isNotNull()).distinct().orderBy("role", "facility_id")


def busiest_corridor(trips: DataFrame) -> DataFrame:
    """(source, destination) with the most trips; ties by key (one row)."""
    return (trips.groupBy("source_center", "destination_center").agg(F.count("*").alias("_n"))
            .where(F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())
            .agg(F.min_by(F.struct("source_center", "destination_center"),
                          F.struct(-F.col("_n"), F.col("source_center"), F.col("destination_center")))
                 .alias("_k"))
            .select("_k.*"))


def delay_vs_volume(corridors: DataFrame) -> DataFrame:
    return corridors.select("source_center", "destination_center", "trip_count", "delay_ratio_mean", "delay_class")


def filter_corridors_by_class(corridors: DataFrame, classes=("Critical", "Severe")) -> DataFrame:
    return (corridors.where(F.col("delay_class").isin(list(classes)))
            .select("source_center", "destination_center", "delay_class", "delay_ratio_mean", "trip_count")
            .orderBy(F.desc("delay_ratio_mean"), "source_center", "destination_center"))


def bidirectional_corridors(corridors: DataFrame) -> DataFrame:
    """Pairs whose reverse pair also exists (self-loops included)."""
    fwd = corridors.select("source_center", "destination_center")
    rev = corridors.select(F.col("destination_center").alias("source_center"),
                           F.col("source_center").alias("destination_center"))
    return fwd.intersect(rev)


def corridor_dedup(legs: DataFrame) -> DataFrame:
    """First row (explicit order) per source center."""
    from .clean import row_order
    return (legs.where(F.col("source_center").isNotNull()).groupBy("source_center")
            .agg(F.min_by(F.struct("trip_uuid", "seg_no", "source_name"), row_order(legs)).alias("_r"))
            .select("source_center", "_r.trip_uuid", "_r.seg_no", "_r.source_name"))
