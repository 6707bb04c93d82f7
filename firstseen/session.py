"""Session settings the jobs were planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates of file names are calendar dates, whatever the cluster's zone.
    "spark.sql.session.timeZone": "UTC",
    # Right-size shuffles at run time and split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated field is no error in JSON; its last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "firstseen", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Recording the call site of every column costs more than small plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return configure(builder.getOrCreate())
