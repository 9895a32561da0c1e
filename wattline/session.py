"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str, cpus: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and measurements. Clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
