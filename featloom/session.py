"""Session defaults used by the bench and the tests; on a cluster the caller brings the session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(cpus: int | None = None, app: str = "featloom") -> SparkSession:
    cores = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(max(cores, 4)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
