"""Trip, corridor and facility aggregates.

Every aggregate here is a single ``groupBy().agg()`` pass so Spark runs a
map-side partial aggregation before the shuffle: a hub that holds a third of
all rows contributes one partial row per map task, not its rows.  The only
aggregates whose buffer grows with the data are the exact ``median`` /
``percentile`` ones (a value→count map per group); ``approx=True`` swaps in
``percentile_approx`` whose buffer has a fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import delay_band, late_flag, safe_div
from ..functions.facility import facility_type_from_name
from ..schema import SLA_FACTOR
from .clean import row_order, row_order_columns

CORRIDOR_KEYS = ["source_center", "destination_center"]


def _median(c: str, approx: bool) -> Column:
    return F.percentile_approx(c, 0.5, 10000) if approx else F.median(c)


def _keys_present(df: DataFrame, keys) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def one_row_join(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The right side is a global aggregate (exactly one row), so broadcasting
    it is size-bounded; the constant key keeps this an equi-join.
    """
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one")
            .drop("_one"))


# --------------------------------------------------------------------- corridors

def corridor_reliability(mean: Column, std: Column) -> Column:
    """clip(1 - std/mean, 0, 1); mean <= 0 → 0; single row (std NULL) → 1."""
    return F.when(mean > 0, F.least(F.greatest(F.lit(1.0) - F.coalesce(std, F.lit(0.0)) / mean,
                                               F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))


def corridor_stats(legs: DataFrame, with_medians: bool = True, approx: bool = False,
                   sla_factor: float = SLA_FACTOR) -> DataFrame:
    """One row per (source_center, destination_center): the graph's edge table."""
    aggs = [F.avg("actual_time").alias("actual_time_mean")]
    if with_medians:
        aggs.append(_median("actual_time", approx).alias("actual_time_median"))
    aggs += [F.stddev_samp("actual_time").alias("actual_time_std"),
             F.count("actual_time").alias("segment_count"),
             F.avg("osrm_time").alias("osrm_time_mean"), F.max("osrm_time").alias("osrm_time_max"),
             F.avg("osrm_distance").alias("osrm_distance_mean"),
             F.max("osrm_distance").alias("osrm_distance_max"),
             F.avg("factor").alias("delay_ratio_mean")]
    if with_medians:
        aggs.append(_median("factor", approx).alias("delay_ratio_median"))
    aggs += [F.stddev_samp("factor").alias("delay_ratio_std"),
             F.mode("route_type", True).alias("primary_route_type"),
             F.count_distinct("trip_uuid").alias("trip_count"),
             F.avg(late_flag("factor", sla_factor)).alias("sla_breach_pct")]
    out = _keys_present(legs, CORRIDOR_KEYS).groupBy(*CORRIDOR_KEYS).agg(*aggs)
    return out.withColumns({
        "corridor_reliability": corridor_reliability(F.col("delay_ratio_mean"), F.col("delay_ratio_std")),
        "delay_class": delay_band("delay_ratio_mean"),
    })


def corridor_impact(corridors: DataFrame) -> DataFrame:
    """(0.4·sla + 0.3·ratio/max ratio + 0.3·trips/max trips)·100."""
    m = corridors.agg(F.max("delay_ratio_mean").alias("_max_ratio"), F.max("trip_count").alias("_max_trips"))
    out = one_row_join(corridors, m)
    impact = (F.coalesce(F.col("sla_breach_pct"), F.lit(0.0)) * 0.4
              + safe_div("delay_ratio_mean", "_max_ratio") * 0.3
              + safe_div("trip_count", "_max_trips") * 0.3) * 100
    return out.withColumn("corridor_impact", impact).drop("_max_ratio", "_max_trips")


def exact_avg(col: str):
    """Mean from fixed-scale decimals: the sum doesn't depend on the order of
    addition, so repeated runs agree in every digit."""
    return F.sum(F.col(col).cast("decimal(28,12)")).cast("double") / F.count(col)


def route_type_corridors(legs: DataFrame) -> DataFrame:
    """Per (route_type, source, destination): the FTL / Carting edge tables."""
    return (_keys_present(legs, ["route_type"] + CORRIDOR_KEYS)
            .groupBy("route_type", *CORRIDOR_KEYS)
            .agg(exact_avg("actual_time").alias("actual_time"), exact_avg("osrm_time").alias("osrm_time"),
                 exact_avg("osrm_distance").alias("distance"), exact_avg("factor").alias("delay_ratio"),
                 F.count_distinct("trip_uuid").alias("frequency"))
            .withColumn("weight", F.col("delay_ratio")))


def time_aware_corridors(legs: DataFrame) -> DataFrame:
    """Corridor edges split by hour of the segment start."""
    return (_keys_present(legs, CORRIDOR_KEYS)
            .withColumn("start_hour", F.hour("od_start_time"))
            .groupBy(*CORRIDOR_KEYS, "start_hour")
            .agg(F.count("*").alias("segment_count"), F.avg("factor").alias("delay_ratio_mean"),
                 F.avg("actual_time").alias("actual_time_mean"),
                 F.count_distinct("trip_uuid").alias("trip_count")))


# -------------------------------------------------------------------- facilities

def _role_stats(legs: DataFrame, key: str, other: str, suffix: str, degree: str,
                approx: bool, sla_factor: float) -> DataFrame:
    sla_name = "sla_breach_pct_src" if suffix == "source" else "sla_breach_pct_dst"
    return (_keys_present(legs, [key]).groupBy(F.col(key).alias("facility_id"))
            .agg(F.avg("actual_time").alias(f"avg_delay_as_{suffix}"),
                 _median("actual_time", approx).alias(f"median_delay_as_{suffix}"),
                 F.count("actual_time").alias(f"throughput_as_{suffix}"),
                 F.avg("osrm_time").alias(f"avg_osrm_as_{suffix}"),
                 F.avg("factor").alias(f"avg_factor_as_{suffix}"),
                 F.stddev_samp("factor").alias(f"factor_std_as_{suffix}"),
                 F.count_distinct(other).alias(degree),
                 F.count_distinct("trip_uuid").alias(f"unique_trips_as_{suffix}"),
                 F.avg(late_flag("factor", sla_factor)).alias(sla_name)))


def facility_names(legs: DataFrame) -> DataFrame:
    """facility_id → name of its first row as source, overridden by the name of
    its first row as destination (a NULL first name gives no mapping)."""
    order = row_order(legs)
    src = (_keys_present(legs, ["source_center"]).groupBy(F.col("source_center").alias("facility_id"))
           .agg(F.min_by("source_name", order).alias("_src_name")))
    dst = (_keys_present(legs, ["destination_center"])
           .groupBy(F.col("destination_center").alias("facility_id"))
           .agg(F.min_by("destination_name", order).alias("_dst_name")))
    return (src.join(dst, "facility_id", "full_outer")
            .select("facility_id", F.coalesce("_dst_name", "_src_name").alias("facility_name")))


def facility_stats(legs: DataFrame, approx: bool = False, sla_factor: float = SLA_FACTOR) -> DataFrame:
    """One row per facility: source-role and destination-role statistics.

    Both role aggregates have one row per facility, so the full outer join
    runs on facility-sized inputs whatever the number of segments.
    """
    src = _role_stats(legs, "source_center", "destination_center", "source", "out_degree", approx, sla_factor)
    dst = _role_stats(legs, "destination_center", "source_center", "dest", "in_degree", approx, sla_factor)
    merged = src.join(dst, "facility_id", "full_outer")
    numeric = [c for c, t in merged.dtypes if c != "facility_id" and not c.startswith("sla_breach")]
    merged = merged.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(dict(merged.dtypes)[c]))
                                 for c in numeric})
    out = merged.withColumns({
        "total_throughput": F.col("throughput_as_source") + F.col("throughput_as_dest"),
        "total_degree": F.col("out_degree") + F.col("in_degree"),
    })
    out = out.withColumns({
        "avg_delay": (F.col("avg_delay_as_source") * F.col("throughput_as_source")
                      + F.col("avg_delay_as_dest") * F.col("throughput_as_dest"))
        / F.greatest(F.col("total_throughput"), F.lit(1)).cast("double"),
        "sla_breach_pct": (F.coalesce("sla_breach_pct_src", F.lit(0.0))
                           + F.coalesce("sla_breach_pct_dst", F.lit(0.0))) / 2,
    })
    names = facility_names(legs)
    return (out.join(names, "facility_id", "left")
            .withColumn("facility_type", facility_type_from_name("facility_name")))


def network_tables(legs: DataFrame, sla_factor: float = SLA_FACTOR) -> tuple[DataFrame, DataFrame]:
    """(facilities, corridors) with the columns of ``facility_stats`` and
    ``corridor_stats`` that the facility graph takes, from one pass.

    The pass gives one row per (source, destination, route type), written
    once; all else is added up from it.  A trip counts at its first row on a
    corridor, names come from the first row of a facility.
    """
    from .graph.core import cut
    once = Window.partitionBy(F.xxhash64("trip_uuid", *CORRIDOR_KEYS), "trip_uuid", *CORRIDOR_KEYS).orderBy(*row_order_columns(legs))
    rows = legs.withColumns({"_new": (F.col("trip_uuid").isNotNull() & (F.row_number().over(once) == 1)).cast("long"),
                             "_late": late_flag("factor", sla_factor)})
    aggs = [x for c in ("actual_time", "osrm_time", "osrm_distance", "factor", "_late")
            for x in (F.count(c).alias(f"{c}_n"), F.sum(c).alias(f"{c}_s"))]
    per = cut(rows.groupBy(*CORRIDOR_KEYS, "route_type").agg(
        *aggs, F.count("route_type").alias("_rows"), F.sum("_new").alias("_trips"), F.var_pop("factor").alias("_var"),
        F.min(F.struct(row_order(legs).alias("at"), "source_name", "destination_name")).alias("_first")))

    def mean(c):
        return F.try_divide(F.sum(f"{c}_s"), F.sum(f"{c}_n"))

    def role(key, other, suffix, degree, name):
        return (_keys_present(per, [key]).groupBy(F.col(key).alias("facility_id"))
                .agg(mean("actual_time").alias(f"avg_delay_as_{suffix}"), F.sum("actual_time_n").alias(f"throughput_as_{suffix}"),
                     F.count_distinct(other).alias(degree), mean("_late").alias(f"_sla_{suffix}"),
                     F.min("_first").getField(name).alias(f"_{suffix}_name")))
    both = (role("source_center", "destination_center", "source", "out_degree", "source_name")
            .join(role("destination_center", "source_center", "dest", "in_degree", "destination_name"), "facility_id", "full_outer")
            .fillna(0, ["throughput_as_source", "throughput_as_dest", "out_degree", "in_degree"])
            .fillna(0.0, ["avg_delay_as_source", "avg_delay_as_dest", "_sla_source", "_sla_dest"])
            .withColumn("total_throughput", F.col("throughput_as_source") + F.col("throughput_as_dest")))
    facilities = both.select(
        "facility_id", F.coalesce("_dest_name", "_source_name").alias("facility_name"), "total_throughput", "in_degree", "out_degree",
        (F.col("out_degree") + F.col("in_degree")).alias("total_degree"),
        ((F.col("avg_delay_as_source") * F.col("throughput_as_source") + F.col("avg_delay_as_dest") * F.col("throughput_as_dest"))
         / F.greatest(F.col("total_throughput"), F.lit(1)).cast("double")).alias("avg_delay"),
        ((F.col("_sla_source") + F.col("_sla_dest")) / 2).alias("sla_breach_pct"),
    ).withColumn("facility_type", facility_type_from_name("facility_name"))

    whole = Window.partitionBy(*CORRIDOR_KEYS)
    own, all_n = F.try_divide("factor_s", "factor_n"), F.sum("factor_n").over(whole)
    apart = F.col("_var") * F.col("factor_n") + F.col("factor_n") * F.pow(own - F.try_divide(F.sum("factor_s").over(whole), all_n), F.lit(2))
    named = F.when(F.col("route_type").isNotNull(), F.struct(-F.col("_rows"), F.col("route_type")))
    n = F.sum("factor_n")
    corridors = (_keys_present(per, CORRIDOR_KEYS).withColumn("_apart", apart).groupBy(*CORRIDOR_KEYS).agg(
        mean("actual_time").alias("actual_time_mean"), mean("osrm_time").alias("osrm_time_mean"), mean("osrm_distance").alias("osrm_distance_mean"),
        mean("factor").alias("delay_ratio_mean"), F.when(n > 1, F.sqrt(F.sum("_apart") / (n - 1))).alias("delay_ratio_std"),
        F.min_by("route_type", named).alias("primary_route_type"), F.sum("_trips").alias("trip_count"), mean("_late").alias("sla_breach_pct"))
        .withColumns({"corridor_reliability": corridor_reliability(F.col("delay_ratio_mean"), F.col("delay_ratio_std")),
                      "delay_class": delay_band("delay_ratio_mean")}))
    return facilities, corridors


def all_facilities(legs: DataFrame) -> DataFrame:
    """Distinct ids seen as source or destination."""
    return (legs.select(F.col("source_center").alias("facility_id"))
            .union(legs.select(F.col("destination_center").alias("facility_id")))
            .where(F.col("facility_id").isNotNull()).distinct())


# ------------------------------------------------------------------------- trips

# fixed values: columns of the trip table by the way they are aggregated
TRIP_FIRST = ["data", "route_schedule_uuid", "route_type", "source_center", "source_name",
              "source_city", "source_state", "source_facility_type", "is_intrastate",
              "trip_creation_time", "od_start_time"]
TRIP_LAST = ["destination_center", "destination_name", "dest_city", "dest_state", "dest_facility_type"]
TRIP_MAX = ["osrm_time", "osrm_distance", "actual_time", "actual_distance_to_destination",
            "start_scan_to_end_scan"]
TRIP_SEGMENT = ["segment_osrm_time", "segment_osrm_distance", "segment_actual_time"]


def _first(c: str) -> Column:
    # first non-null value in segment order (NULL orderings are skipped)
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seg_no")))


def _last(c: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seg_no")))


def agg_trips(legs: DataFrame) -> DataFrame:
    """One row per trip from cleaned segments (cumulative columns → max)."""
    cols = set(legs.columns)
    aggs = [_first(c).alias(c) for c in TRIP_FIRST if c in cols]
    aggs += [_last(c).alias(c) for c in TRIP_LAST if c in cols]
    aggs += [F.max(c).alias(c) for c in TRIP_MAX if c in cols]
    for c in TRIP_SEGMENT:
        aggs += [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{c}_sum"), F.avg(c).alias(f"{c}_mean"),
                 F.stddev_samp(c).alias(f"{c}_std"), F.max(c).alias(f"{c}_max")]
    aggs += [F.max("factor").alias("factor"),
             F.coalesce(F.sum(F.col("is_cutoff").cast("int")), F.lit(0)).cast("bigint").alias("cutoff_count"),
             F.count("*").alias("num_segments")]
    trips = _keys_present(legs, ["trip_uuid"]).groupBy("trip_uuid").agg(*aggs)
    return trips.withColumn("osrm_speed", F.when(F.col("osrm_time") > 0,
                                                 F.col("osrm_distance") / (F.col("osrm_time") / 60))
                            .otherwise(F.lit(0.0)))


def trip_speed(trips: DataFrame) -> DataFrame:
    return trips.select("trip_uuid", F.when(F.col("osrm_time") > 0,
                                            F.col("osrm_distance") / (F.col("osrm_time") / 60))
                        .otherwise(F.lit(0.0)).alias("osrm_speed"))
