"""Session helper for local runs and tests (a cluster brings its own)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(cpus: int | str | None = None, app: str = "record_loader") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    return (SparkSession.builder.master(f"local[{cpus}]").appName(app)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "16g")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())
