"""Session settings the jobs are tested and measured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, **settings: str) -> SparkSession:
    """A local session without web page; ``settings`` replace dots by double underscores."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("carelake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
