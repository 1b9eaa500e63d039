"""A Spark session for tests and the bench; jobs take whatever session they are given."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "tarnwatch",
                  **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
