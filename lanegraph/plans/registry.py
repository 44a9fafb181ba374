"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the shared tables through ``legs_from_tables`` so its
work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_data
from ..sources.segments import legs_from_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs_from_tables(spark, sf_dir)


def clean_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_data(legs_from_tables(spark, sf_dir))


@query("corridor_bottlenecks")
def _corridor_bottlenecks(spark, sf_dir):
    from .corridor_report import corridor_bottlenecks
    return corridor_bottlenecks(legs(spark, sf_dir))


# ----------------------------------------------------------------- presentation

def finish(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round doubles and render timestamps as text for stable comparison."""
    from pyspark.sql import functions as F
    out = {}
    for c, t in df.dtypes:
        if t in ("double", "float"):
            r = F.round(F.col(c), digits)
            out[c] = F.when(r == 0, F.lit(0.0)).otherwise(r)  # no negative zero
        elif t.startswith("timestamp"):
            out[c] = F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out) if out else df


def above_ties(df: DataFrame, *cols: str) -> DataFrame:
    """Move exact ties of the presented rounding to one side, alike in any engine."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.col(c) + F.lit(1e-12) for c in cols})
