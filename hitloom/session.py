"""Session settings the marts are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # A malformed date or number must fail, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The marts deduplicate straight after joining on the partitioning of that join.  When one
    # partition of the join is skewed, this lets AQE split it anyway and add a shuffle behind the
    # partial deduplication; without skew no shuffle is added.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Exports and shuffled events grow many times when they are unpacked; these bound the rows of a task.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The JVM does not compile methods above 8000 bytes.  A mart projects dozens of lookups at once;
    # beyond this limit Spark generates them as many small methods instead of one that stays
    # interpreted (measured: seven times faster).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(folder: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; tables between steps go to ``folder``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hitloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # A mart builds several hundred column expressions; recording a call site for each is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return apply_settings(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables written between steps.

    It is ``spark.checkpoint.dir`` of the session, or else the checkpoint folder set on its context.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")
