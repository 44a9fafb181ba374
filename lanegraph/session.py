"""Session helpers.

The library never owns a global session: every operator takes DataFrames
and returns DataFrames.  These helpers exist for scripts, tests and the
bench, and for iterative graph operators that must cut lineage.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lanegraph") -> SparkSession:
    """Local session with the settings used by tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session, registered as checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` has to name it (an error otherwise);
    only a local master gets a fresh scratch folder.
    """
    from .scratch import shared_dir
    path = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path
