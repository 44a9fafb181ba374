"""Corridor statistics over a stream of segment observations.

``withWatermark`` bounds the state kept for late segments; each (window,
corridor) row is emitted once its window closes (append mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import late_flag
from ..schema import SLA_FACTOR


def streaming_corridor_stats(segments: DataFrame, window: str = "1 day", lateness: str = "6 hours",
                             time_col: str = "od_start_time") -> DataFrame:
    """Tumbling-window corridor aggregates for a streaming (or batch) segment frame."""
    return (segments.withWatermark(time_col, lateness)
            .where(F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())
            .groupBy(F.window(time_col, window).alias("w"), "source_center", "destination_center")
            .agg(F.count("*").alias("segment_count"), F.avg("factor").alias("delay_ratio_mean"),
                 F.avg(late_flag("factor", SLA_FACTOR)).alias("sla_breach_pct"),
                 F.approx_count_distinct("trip_uuid").alias("approx_trip_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "source_center", "destination_center", "segment_count", "delay_ratio_mean",
                    "sla_breach_pct", "approx_trip_count"))


def start_stream(spark, source_dir: str, schema, sink_dir: str, checkpoint_dir: str):
    """File-source → windowed corridor stats → parquet sink (exactly-once via checkpoint)."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    return (streaming_corridor_stats(stream).writeStream.outputMode("append").format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint_dir).start())
