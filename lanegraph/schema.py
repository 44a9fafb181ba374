"""Schemas of the segment (leg) table and its derived tables."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType,
                               StringType, StructField, StructType)

# Raw segment observation as delivered in the CSV export (24 columns).
# Timestamps arrive as strings and are parsed by ``parse_datetimes``.
RAW_SEGMENT = StructType([
    StructField("data", StringType()),
    StructField("trip_creation_time", StringType()),
    StructField("route_schedule_uuid", StringType()),
    StructField("route_type", StringType()),
    StructField("trip_uuid", StringType()),
    StructField("source_center", StringType()),
    StructField("source_name", StringType()),
    StructField("destination_center", StringType()),
    StructField("destination_name", StringType()),
    StructField("od_start_time", StringType()),
    StructField("od_end_time", StringType()),
    StructField("start_scan_to_end_scan", DoubleType()),
    StructField("is_cutoff", BooleanType()),
    StructField("cutoff_factor", IntegerType()),
    StructField("cutoff_timestamp", StringType()),
    StructField("actual_distance_to_destination", DoubleType()),
    StructField("actual_time", DoubleType()),
    StructField("osrm_time", DoubleType()),
    StructField("osrm_distance", DoubleType()),
    StructField("factor", DoubleType()),
    StructField("segment_actual_time", DoubleType()),
    StructField("segment_osrm_time", DoubleType()),
    StructField("segment_osrm_distance", DoubleType()),
    StructField("segment_factor", DoubleType()),
])

TIMESTAMP_COLUMNS = ("trip_creation_time", "od_start_time", "od_end_time", "cutoff_timestamp")

DOUBLE_COLUMNS = tuple(f.name for f in RAW_SEGMENT.fields if isinstance(f.dataType, DoubleType))

# Split labels used by the source data.
TRAIN_VALUE = "training"
TEST_VALUE = "test"

# Corridor delay bands, right-closed (lower, upper] on the mean ratio.
DELAY_BANDS = ((0.0, 1.3, "Healthy"), (1.3, 2.0, "Moderate"), (2.0, 3.0, "Severe"),
               (3.0, float("inf"), "Critical"))

# Share of late segments is measured against this ratio.
SLA_FACTOR = 1.5

SEG_ORDER = "seg_no"
