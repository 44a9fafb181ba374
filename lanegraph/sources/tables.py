"""Readers for the shared parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)
