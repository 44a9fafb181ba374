"""Trip-level features: temporal, route, spatial and encodings.

All features are built-in expressions.  Encodings are *fitted* on the
training split (a small vocabulary / per-center mean table) and applied to
every split with a join, so train and test share one mapping.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import finite_or_zero, null_safe_equal_int

# The tabular feature list of the ETA models (non-leaky columns).
FEATURE_COLS = [
    "osrm_time", "osrm_distance", "is_ftl", "num_segments",
    "creation_hour", "creation_day_of_week", "creation_is_weekend",
    "creation_is_peak", "creation_is_night",
    "creation_hour_sin", "creation_hour_cos",
    "creation_dow_sin", "creation_dow_cos",
    "start_hour", "start_is_peak",
    "time_since_creation_min",
    "is_intrastate",
    "source_center_encoded", "destination_center_encoded",
    "source_facility_type_encoded", "dest_facility_type_encoded",
    "source_state_encoded", "dest_state_encoded",
    "osrm_speed_kmh", "log_osrm_time", "log_osrm_distance",
    "log_num_segments", "cutoff_count",
    "segment_osrm_time_sum", "segment_osrm_time_mean",
    "segment_osrm_distance_sum", "segment_osrm_distance_mean",
    "avg_segment_distance", "avg_segment_time",
]
TARGET_COL = "actual_time"

# Peak and night hours.
PEAK_HOURS = [8, 9, 10, 17, 18, 19]
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4, 5]

# Columns that leak the target (known only after arrival).
LEAKY_COLS = ["actual_time", "cutoff_factor", "od_end_time", "start_scan_to_end_scan", "actual_distance_to_destination",
              "segment_actual_time", "factor", "segment_factor", "cutoff_timestamp"]


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def temporal_features(df: DataFrame) -> DataFrame:
    ch = F.hour("trip_creation_time")
    dow = F.weekday("trip_creation_time")
    sh = F.hour("od_start_time")
    return df.withColumns({
        "creation_hour": ch,
        "creation_day_of_week": dow,
        "creation_is_weekend": _flag(dow >= 5),
        "creation_is_peak": _flag(ch.isin(PEAK_HOURS)),
        "creation_is_night": _flag(ch.isin(NIGHT_HOURS)),
        "creation_day_of_month": F.dayofmonth("trip_creation_time"),
        "creation_week_of_year": F.weekofyear("trip_creation_time"),
        "start_hour": sh,
        "start_is_peak": _flag(sh.isin(PEAK_HOURS)),
    })


def cyclic_encoding(df: DataFrame) -> DataFrame:
    two_pi = 2 * math.pi
    return df.withColumns({
        "creation_hour_sin": F.sin(two_pi * F.col("creation_hour") / 24),
        "creation_hour_cos": F.cos(two_pi * F.col("creation_hour") / 24),
        "creation_dow_sin": F.sin(two_pi * F.col("creation_day_of_week") / 7),
        "creation_dow_cos": F.cos(two_pi * F.col("creation_day_of_week") / 7),
    })


def time_since_creation(df: DataFrame) -> DataFrame:
    """Minutes from creation to start (microsecond precision), floor 0, missing → 0."""
    mins = F.timestamp_diff("MICROSECOND", F.col("trip_creation_time"), F.col("od_start_time")) / 6e7
    return df.withColumn("time_since_creation_min", F.greatest(F.coalesce(mins, F.lit(0.0)), F.lit(0.0)))


def _clip0(c: str) -> Column:
    # clip at 0 that keeps NULL (greatest() would turn NULL into 0)
    return F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c))


def route_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_ftl": _flag(F.col("route_type") == "FTL"),
        "osrm_speed_kmh": F.when(F.col("osrm_time") > 0, F.col("osrm_distance") / (F.col("osrm_time") / 60))
        .otherwise(F.lit(0.0)),
        "log_osrm_time": F.log1p(_clip0("osrm_time")),
        "log_osrm_distance": F.log1p(_clip0("osrm_distance")),
        "log_num_segments": F.log1p(F.col("num_segments")),
        "log_segment_osrm_time_sum": F.log1p(F.coalesce(_clip0("segment_osrm_time_sum"), F.lit(0.0))),
        "log_segment_osrm_distance_sum": F.log1p(F.coalesce(_clip0("segment_osrm_distance_sum"), F.lit(0.0))),
        "avg_segment_distance": F.when(F.col("num_segments") > 0,
                                       F.col("segment_osrm_distance_sum") / F.col("num_segments"))
        .otherwise(F.lit(0.0)),
        "avg_segment_time": F.when(F.col("num_segments") > 0,
                                   F.col("segment_osrm_time_sum") / F.col("num_segments"))
        .otherwise(F.lit(0.0)),
    })


def spatial_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_same_city": null_safe_equal_int("source_city", "dest_city"),
        "facility_type_pair": F.concat_ws("_", F.coalesce("source_facility_type", F.lit("X")),
                                          F.coalesce("dest_facility_type", F.lit("X"))),
    })


# -------------------------------------------------------------------- encodings

LABEL_COLS = ("source_facility_type", "dest_facility_type", "source_state", "dest_state", "facility_type_pair")
MEAN_COLS = ("source_center", "destination_center")
#: Most rows of a fitted encoding that are broadcast; it is counted first.
BROADCAST_CODES = 200_000


def _long(df: DataFrame, cols, *keep) -> DataFrame:
    """(column, value, …) rows, one per listed column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in cols.items()])
    out = df.select(*keep, F.explode(pairs).alias("x"))
    return out.select(*[c for c in out.columns if c != "x"], "x.column", "x.value")


def encode_trips(trips: DataFrame, train: DataFrame) -> DataFrame:
    """Target-encode centers and label-encode types/states/type pair, fitted on ``train``.

    All vocabularies come from one aggregate in long form, both target means
    from another; what they give is counted and broadcast below a limit, so the
    trip table is not shuffled for them.
    """
    from .aggregate import one_row_join
    from .graph.core import cut
    values = {c: (F.col(c) if c == "facility_type_pair" else F.coalesce(F.col(c), F.lit("Unknown"))) for c in LABEL_COLS}
    vocab = _long(spatial_features(train), values).where("value is not null").distinct()
    codes = cut(vocab.withColumn("code", (F.dense_rank().over(Window.partitionBy("column").orderBy("value")) - 1).cast("int")))
    target = F.col(TARGET_COL).alias("_y")
    means = cut(_long(train, {c: F.col(c) for c in MEAN_COLS}, target).where("value is not null")
                .groupBy("column", "value").agg(F.avg("_y").alias("mean")))
    hint = F.broadcast if codes.count() + means.count() <= BROADCAST_CODES else (lambda t: t)
    out = one_row_join(trips, train.agg(F.avg(TARGET_COL).alias("_te_global")))
    for c in MEAN_COLS:
        own = means.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("mean").alias("_te"))
        out = (out.join(hint(own), out[c] == own["_value"], "left").withColumn(f"{c}_encoded", F.coalesce("_te", "_te_global"))
               .drop("_value", "_te"))
    for c in LABEL_COLS:
        own = codes.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        out = (out.join(hint(own), values[c] == own["_value"], "left").withColumn(f"{c}_encoded", F.coalesce("_code", F.lit(-1)).cast("int"))
               .drop("_value", "_code"))
    return out.drop("_te_global")


def trip_features(trips: DataFrame, train_value: str = "training") -> DataFrame:
    """All trip features; encodings fitted on the training trips."""
    base = route_features(spatial_features(time_since_creation(cyclic_encoding(temporal_features(trips)))))
    # seven encodings are fitted on and applied to this table: materialise it once
    # (reliable checkpoint) instead of recomputing the trip aggregation per branch
    from .graph.core import cut
    base = cut(base)
    train = base.where(F.col("data") == train_value)
    return encode_trips(base, train)


def impute_matrix(df: DataFrame, feature_cols=None) -> DataFrame:
    """NULL/NaN/±inf → 0 on the feature list; absent columns are dropped."""
    cols = [c for c in (feature_cols or FEATURE_COLS) if c in df.columns]
    return df.withColumns({c: finite_or_zero(c) for c in cols})


def leaky_columns_used(feature_cols) -> list[str]:
    return [c for c in feature_cols if c in LEAKY_COLS]
