"""Data audit / profiling of the segment table (one or two passes each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.facility import state_from_last_paren

PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
NUMERIC = ["start_scan_to_end_scan", "cutoff_factor", "actual_distance_to_destination", "actual_time",
           "osrm_time", "osrm_distance", "factor", "segment_actual_time", "segment_osrm_time",
           "segment_osrm_distance", "segment_factor"]


def graph_feasibility(legs: DataFrame) -> DataFrame:
    ends = (legs.select(F.col("source_center").alias("f")).union(legs.select(F.col("destination_center").alias("f")))
            .where(F.col("f").isNotNull()).agg(F.count_distinct("f").alias("facilities")))
    base = legs.agg(F.count_distinct("source_center").alias("sources"),
                    F.count_distinct("destination_center").alias("destinations"),
                    F.count_distinct("source_name").alias("source_names"),
                    F.count_distinct("source_center", "destination_center").alias("corridors"))
    from .aggregate import one_row_join
    out = one_row_join(base, ends)
    return out.withColumn("density", F.col("corridors") / (F.col("facilities") * F.col("facilities")).cast("double"))


def corridor_frequency(legs: DataFrame) -> DataFrame:
    c = (legs.where(F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())
         .groupBy("source_center", "destination_center").agg(F.count("*").alias("n")))
    return c.agg(F.avg("n").alias("mean_rows"), F.median("n").alias("median_rows"), F.max("n").alias("max_rows"),
                 F.min("n").alias("min_rows"), F.count_if(F.col("n") == 1).alias("single_row_corridors"),
                 F.count_if(F.col("n") > 100).alias("busy_corridors"),
                 F.count_if(F.col("source_center") == F.col("destination_center")).alias("self_loops"))


def route_type_per_corridor(legs: DataFrame) -> DataFrame:
    return legs.groupBy("source_center", "destination_center", "route_type").agg(F.count("*").alias("rows"))


def trip_structure(legs: DataFrame) -> DataFrame:
    t = legs.groupBy("trip_uuid").agg(F.count("*").alias("n"))
    return t.agg(F.avg("n").alias("mean_segments"), F.median("n").alias("median_segments"),
                 F.min("n").alias("min_segments"), F.max("n").alias("max_segments"), F.count("*").alias("trips"),
                 (F.avg((F.col("n") == 1).cast("double")) * 100).alias("single_segment_pct"),
                 (F.avg((F.col("n") > 1).cast("double")) * 100).alias("multi_segment_pct"))


def trip_size_distribution(legs: DataFrame) -> DataFrame:
    """Trips per number of segments."""
    return legs.groupBy("trip_uuid").agg(F.count("*").alias("segments")).groupBy("segments").agg(F.count("*").alias("trips"))


def schedule_structure(legs: DataFrame) -> DataFrame:
    s = legs.groupBy("route_schedule_uuid").agg(F.count("*").alias("n"), F.count_distinct("route_type").alias("k"))
    return s.agg(F.count("*").alias("schedules"), F.avg("n").alias("mean_rows"), F.max("n").alias("max_rows"),
                 F.count_if(F.col("k") == 1).alias("single_type"), F.count_if(F.col("k") > 1).alias("multi_type"))


def temporal_profile(legs: DataFrame) -> DataFrame:
    ts = F.col("trip_creation_time")
    by_hour = legs.groupBy(F.lit("hour").alias("unit"), F.hour(ts).alias("value")).agg(F.count("*").alias("rows"))
    by_day = legs.groupBy(F.lit("weekday").alias("unit"), F.weekday(ts).alias("value")).agg(F.count("*").alias("rows"))
    return by_hour.unionByName(by_day)


def temporal_range(legs: DataFrame) -> DataFrame:
    """First and last trip creation and the whole days between them."""
    ts = F.col("trip_creation_time")
    return legs.agg(F.min(ts).alias("first"), F.max(ts).alias("last"),
                    F.datediff(F.max(ts), F.min(ts)).alias("span_days"))


def target_percentiles(legs: DataFrame, col: str = "actual_time") -> DataFrame:
    from .aggregate import one_row_join
    from .quantiles import one_quantiles
    q = one_quantiles(legs, col, {f"p{int(round(p * 100)):02d}": p for p in PERCENTILES})
    return one_row_join(q, legs.agg(F.count_if(F.col(col) == 0).alias("zeros"), F.count_if(F.col(col) < 0).alias("negatives")))


def actual_vs_planned(legs: DataFrame) -> DataFrame:
    r = F.when(F.col("osrm_time") > 0, F.col("actual_time") / F.col("osrm_time"))
    x = legs.select(r.alias("r")).where(F.col("r").isNotNull())
    from .aggregate import one_row_join
    from .quantiles import one_quantiles
    rest = x.agg(F.avg("r").alias("ratio_mean"),
                 (F.avg((F.col("r") < 1).cast("double")) * 100).alias("pct_faster"),
                 (F.avg((F.col("r") > 1).cast("double")) * 100).alias("pct_slower"),
                 (F.avg((F.col("r") > 2).cast("double")) * 100).alias("pct_over_2x"))
    return one_row_join(rest, one_quantiles(x, "r", {"ratio_median": 0.5}))


def target_correlation(legs: DataFrame, target: str = "actual_time", cols=NUMERIC) -> DataFrame:
    cols = [c for c in cols if c in legs.columns and c != target]
    r = legs.agg(*[F.corr(F.col(target), F.col(c).cast("double")).alias(c) for c in cols])
    long = r.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in cols]))
                    .alias("x")).select("x.*")
    return long.withColumn("leaky", F.coalesce(F.abs("r") > 0.95, F.lit(False)))


def state_profile(legs: DataFrame) -> DataFrame:
    s = legs.select(state_from_last_paren("source_name").alias("ss"), state_from_last_paren("destination_name").alias("ds"))
    return s.agg(F.count_distinct("ss").alias("source_states"), F.count_distinct("ds").alias("dest_states"),
                 (F.avg(F.coalesce(F.col("ss") == F.col("ds"), F.lit(False)).cast("double")) * 100).alias("intra_pct"),
                 (F.avg(F.coalesce(F.col("ss") != F.col("ds"), F.lit(True)).cast("double")) * 100).alias("inter_pct"))


def top_states(legs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` source states with most segments (ties by name)."""
    return (legs.select(state_from_last_paren("source_name").alias("state")).where("state is not null").groupBy("state")
            .agg(F.count("*").alias("segments")).orderBy(F.desc("segments"), "state").limit(k))


def factor_profile(legs: DataFrame) -> DataFrame:
    """Delay factor per route type and over all rows (``ALL``)."""
    from .quantiles import exact_quantiles
    f = F.col("factor")
    both = legs.select(F.explode(F.array(F.col("route_type"), F.lit("ALL"))).alias("route_type"), "factor")
    rest = both.groupBy("route_type").agg(
        F.avg(f).alias("factor_mean"),
        (F.avg(F.coalesce(f > 1.3, F.lit(False)).cast("double")) * 100).alias("pct_over_1_3"),
        F.count_if(f <= 1.0).alias("on_time"), F.count_if((f > 1.0) & (f <= 1.3)).alias("mild"),
        F.count_if((f > 1.3) & (f <= 2.0)).alias("moderate"), F.count_if(f > 2.0).alias("severe"))
    return rest.join(exact_quantiles(both, ["route_type"], "factor", {"factor_median": 0.5}), "route_type", "left")


def cutoff_profile(legs: DataFrame) -> DataFrame:
    return legs.groupBy("is_cutoff").agg(F.count("*").alias("rows"), F.avg("cutoff_factor").alias("cutoff_factor_mean"),
                                         F.count_distinct("cutoff_factor").alias("cutoff_factor_distinct"),
                                         F.min("cutoff_factor").alias("cutoff_factor_min"),
                                         F.max("cutoff_factor").alias("cutoff_factor_max"))


def profile_missing(legs: DataFrame) -> DataFrame:
    """Nulls per column; an empty string is missing as well."""
    kinds = dict(legs.dtypes)
    cols = legs.columns
    gone = {c: F.col(c).isNull() | (F.col(c) == "") if kinds[c] == "string" else F.col(c).isNull() for c in cols}
    r = legs.agg(F.count("*").alias("_n"), *[F.count_if(gone[c]).alias(c) for c in cols])
    long = r.select("_n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"))
                                              for c in cols])).alias("x")).select("_n", "x.*")
    return long.select("column", "missing", (F.col("missing") * 100.0 / F.col("_n")).alias("missing_pct"))


def quality_summary(legs: DataFrame) -> DataFrame:
    cols = legs.columns
    nulls = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0))
    dup = legs.groupBy(*cols).agg(F.count("*").alias("_k"))
    from .aggregate import one_row_join
    a = legs.agg(F.count("*").alias("rows"), F.sum(nulls).alias("missing_cells"),
                 F.count_if(F.col("segment_actual_time") < 0).alias("negative_segment_time"),
                 F.count_if(F.col("segment_osrm_time") == 0).alias("zero_planned_time"),
                 F.count_if(F.col("actual_time") <= 0).alias("bad_actual_time"), F.count_if(F.col("osrm_time") <= 0).alias("bad_osrm_time"),
                 F.count_if(F.col("osrm_distance") <= 0).alias("bad_distance"),
                 sum(((F.count(c) == F.count("*")).cast("int") for c in cols), F.lit(0)).alias("complete_columns"))
    d = dup.agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).alias("duplicate_rows"))
    return one_row_join(a, d).withColumn(
        "completeness_pct", 100.0 - F.col("missing_cells") * 100.0 / (F.col("rows") * len(cols)))


def profile_columns(legs: DataFrame, cols=tuple(NUMERIC)) -> DataFrame:
    """Numeric profile per column, in long form: (column, value) rows are
    aggregated per column, distinct counts and quantiles from the counted values.
    Skewness and kurtosis are the bias-corrected sample statistics:
    G1 = g1·√(n(n−1))/(n−2),  G2 = (n−1)/((n−2)(n−3))·((n+1)·g2 + 6)."""
    from .graph.core import cut
    from .quantiles import exact_quantiles
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    long = cut(legs.select(F.explode(pairs).alias("p")).select("p.*"))
    x = F.col("x")
    base = long.groupBy("column").agg(
        F.count("*").alias("_rows"), F.count(x).alias("non_null"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"),
        F.count_if(x == 0).alias("zeros"), F.count_if(x < 0).alias("negatives"))
    distinct = long.where("x is not null").distinct().groupBy("column").agg(F.count("*").alias("distinct"))
    q = cut(exact_quantiles(long, ["column"], "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    fence = (F.col("q3") - F.col("q1")) * 1.5
    out = (long.join(F.broadcast(q), "column").where((x < F.col("q1") - fence) | (x > F.col("q3") + fence))  # a row per column
           .groupBy("column").agg(F.count("*").alias("_out")))
    all_ = base.join(distinct, "column", "left").join(q, "column", "left").join(out, "column", "left")
    n = F.col("non_null").cast("double")
    return all_.select(
        "column", "non_null", ((F.col("_rows") - F.col("non_null")) * 100.0 / F.col("_rows")).alias("null_pct"),
        F.coalesce("distinct", F.lit(0)).alias("distinct"), "min", "max", "mean", "median", "std",
        F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6)).alias("kurtosis"),
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        F.when(n > 0, F.coalesce("_out", F.lit(0)) * 100.0 / n).alias("outlier_pct"), "zeros", "negatives")


def profile_types(legs: DataFrame) -> DataFrame:
    """Every column with its type, non-null rows and distinct values."""
    kinds = dict(legs.dtypes)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c].split("(")[0]).alias("type"), F.col(c).cast("string").alias("value"))
                      for c in legs.columns])
    counted = legs.select(F.explode(pairs).alias("p")).select("p.*").groupBy("column", "type", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("column", "type").agg(F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
                                                 F.count("value").alias("distinct"))


TEXT_COLS = ["data", "route_schedule_uuid", "route_type", "trip_uuid", "source_center", "source_name",
             "destination_center", "destination_name"]


def profile_top_values(legs: DataFrame, cols=TEXT_COLS, k: int = 10) -> DataFrame:
    """Top-k values with their share of non-null values per text column.

    Counting is a partial aggregate per (column, value); the rank limit is
    applied in each task before the values of a column meet.  Ties go by value.
    """
    from pyspark.sql import Window
    cols = [c for c in cols if c in legs.columns]
    long = legs.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                           for c in cols])).alias("x")).select("x.*")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.col("value"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)      # limited per task before the shuffle
    total = counts.groupBy("column").agg(F.sum("count").alias("_all"))                      # one row per column
    return top.join(F.broadcast(total), "column").withColumn("pct", F.col("count") * 100.0 / F.col("_all")).drop("_all")
