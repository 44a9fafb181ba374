"""Shared column helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that does not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_of(df: DataFrame, col: str = "text") -> Column:
    """Whole text, null as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only (``lower`` would fold other scripts too)."""
    return F.translate(text, UPPER, UPPER.lower())


def small_batches(spark, size: int = 4 << 20) -> None:
    """Arrow batches of about ``size`` bytes from here on in this session.

    Spark's default is 10,000 rows whatever their size, which for whole texts
    is tens of megabytes in the executor and again in its Python worker.  A
    smaller limit that the session already has is left alone.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    parse = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if parse(spark.conf.get(key)) > size:
        spark.conf.set(key, str(size))
