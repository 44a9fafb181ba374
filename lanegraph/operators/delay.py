"""Delay classification, distribution, SLA contribution and summaries.

Inputs are corridor tables (one row per corridor); global totals are one-row
aggregates attached with a size-bounded broadcast, never a window over ().
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import delay_band
from .aggregate import one_row_join

CLASSES = ["Healthy", "Moderate", "Severe", "Critical"]


def classify_corridors(corridors: DataFrame) -> DataFrame:
    return corridors.withColumn("delay_class", delay_band("delay_ratio_mean"))


def delay_distribution(classified: DataFrame) -> DataFrame:
    """Count and share of all corridors per class (NULL class not listed)."""
    total = classified.agg(F.count("*").alias("_total"))
    counts = classified.where(F.col("delay_class").isNotNull()).groupBy("delay_class").agg(
        F.count("*").alias("corridors"))
    return (one_row_join(counts, total)
            .withColumn("pct", F.col("corridors") * 100.0 / F.col("_total")).drop("_total"))


def delay_summary(classified: DataFrame) -> DataFrame:
    aggs = [F.count("*").alias("total_corridors")]
    aggs += [(F.avg(F.coalesce(F.col("delay_class") == c, F.lit(False)).cast("double")) * 100)
             .alias(f"{c.lower()}_pct") for c in CLASSES]
    aggs += [F.avg("delay_ratio_mean").alias("avg_delay_ratio"),
             F.median("delay_ratio_mean").alias("median_delay_ratio")]
    return classified.agg(*aggs)


def top_delayed_corridors(corridors: DataFrame, top_n: int = 20) -> DataFrame:
    return corridors.orderBy(F.desc("delay_ratio_mean"), "source_center", "destination_center").limit(top_n)


def sla_totals(classified: DataFrame, breach_threshold: float = 0.3) -> DataFrame:
    return classified.agg(
        F.count("*").alias("total_corridors"),
        F.count_if(F.col("sla_breach_pct") > breach_threshold).alias("breaching_corridors"),
        F.count_if(F.col("delay_class") == "Critical").alias("critical_corridors"))


def sla_contribution(corridors: DataFrame) -> DataFrame:
    """breach share × trips per corridor and its % of the network total."""
    c = corridors.select("source_center", "destination_center", "sla_breach_pct", "trip_count",
                         "delay_ratio_mean",
                         (F.col("sla_breach_pct") * F.col("trip_count")).alias("sla_contribution"))
    total = c.agg(F.sum("sla_contribution").alias("_total"))
    return (one_row_join(c, total)
            .withColumn("sla_contribution_pct",
                        F.when(F.col("_total") > 0, F.col("sla_contribution") / F.col("_total") * 100)
                        .otherwise(F.lit(0.0)))
            .drop("_total"))


def run_delay_analysis(corridors: DataFrame, top_n: int = 20) -> dict[str, DataFrame]:
    classified = classify_corridors(corridors)
    return {"classified_corridors": classified,
            "top_delayed": top_delayed_corridors(classified, top_n),
            "sla_contribution": sla_contribution(classified),
            "sla_totals": sla_totals(classified),
            "summary": delay_summary(classified)}
