"""Flagship: corridor bottleneck report over training segments.

segments → training filter → corridor aggregate (one pass, partial
aggregation) → reliability, band, impact (one-row broadcast of the global
maxima over the written corridors) → top-k by impact with key tiebreakers (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import corridor_impact, corridor_stats
from ..operators.graph.core import cut
from ..schema import TRAIN_VALUE


def corridor_bottlenecks(legs: DataFrame, top_n: int = 20, train_value: str = TRAIN_VALUE) -> DataFrame:
    train = legs.where(F.col("data") == train_value)
    stats = corridor_stats(train, with_medians=False).select(
        "source_center", "destination_center", "segment_count", "trip_count", "delay_ratio_mean", "sla_breach_pct", "corridor_reliability", "delay_class")
    c = corridor_impact(cut(stats))
    return (c.select(
        "source_center", "destination_center", "segment_count", "trip_count",
        F.round("delay_ratio_mean", 9).alias("delay_ratio_mean"),
        F.round("sla_breach_pct", 9).alias("sla_breach_pct"),
        F.round("corridor_reliability", 9).alias("corridor_reliability"),
        "delay_class",
        F.round("corridor_impact", 9).alias("corridor_impact"))
        .orderBy(F.desc("corridor_impact"), "source_center", "destination_center")
        .limit(top_n))
