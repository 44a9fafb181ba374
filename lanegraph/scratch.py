"""Written intermediate tables in the session's shared folder.

Long jobs cut their lineage by writing a table to the folder named by
``spark.checkpoint.dir`` and reading it back: executors can be lost at any
time without losing the work, and the re-read plan starts from real file
sizes instead of the estimates of everything above it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session.

    ``spark.checkpoint.dir`` is used as it is.  A scratch folder of this
    machine stands in for it only on a local master, where driver and
    executors are one process; elsewhere an unset folder is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lanegraph-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store ``path`` names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """A private sub-folder of the shared folder holding written tables."""

    def __init__(self, spark: SparkSession, label: str = "work"):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lanegraph-{label}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:04d}-{name}"

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write ``df`` as Parquet and return it read back (same schema)."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables written by this object that nothing needs any more."""
        for t in tables:
            path = getattr(t, "_scratch_path", None)
            if path and path.startswith(self.root):
                remove_path(self.spark, path)
