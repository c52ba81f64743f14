"""Session settings the package is tested with; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "tidewire", **settings) -> SparkSession:
    """A ``local[cpus]`` session for tests, benchmarks and trials."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
