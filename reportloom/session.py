"""Session builder for tests, the bench and ad-hoc runs; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, app: str = "reportloom") -> SparkSession:
    cpus = str(cpus or os.environ.get("BENCH_CPUS") or 8)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
