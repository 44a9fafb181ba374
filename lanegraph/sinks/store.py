"""Every writer takes a folder of any store that Spark reaches.

A set of tables is committed by its catalogue, written last: a folder without
one holds nothing that the readers would open.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE = "_catalogue"


def write_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite", partition_by: dict[str, list[str]] | None = None) -> None:
    """One Parquet table per entry, then the catalogue (name, columns)."""
    if not tables:
        raise ValueError("no tables to write")
    for name, df in tables.items():
        df.write.mode(mode).partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{folder}/{name}")
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, df.schema.json()) for name, df in tables.items()]
    spark.createDataFrame(rows, "name string, columns string").coalesce(1).write.mode("overwrite").json(f"{folder}/{CATALOGUE}")


def read_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of a written set by name; a missing catalogue is an error."""
    names = [r["name"] for r in spark.read.schema("name string, columns string").json(f"{folder}/{CATALOGUE}").orderBy("name").collect()]
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def write_summary_json(summary: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document (nulls kept)."""
    one = summary.select(F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"}).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def read_summary_json(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(path).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path}: {len(rows)} documents, one expected")
    return json.loads(rows[0]["value"])


def write_graph(vertices: DataFrame, edges: DataFrame, folder: str) -> None:
    """Vertices and edges; edges are sorted by source in their files."""
    write_tables({"vertices": vertices, "edges": edges.sortWithinPartitions("src", "dst")}, folder)


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    marts = read_marts(spark, folder)
    return marts["vertices"], marts["edges"]


def write_model(model: PipelineModel, path: str) -> None:
    """A fitted pipeline with all its stages."""
    model.write().overwrite().save(path)


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
