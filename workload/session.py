"""A local session for tests, checks and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None) -> SparkSession:
    cores = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wharfline")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
