"""Session helpers.

Library code never creates a session; these helpers are for tests, the bench
and command-line use.  On a cluster the submitter's settings win: nothing here
overrides a value that is already set.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rasterprep", driver_memory: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on).

    ``driver_memory`` defaults to ``$RASTERPREP_DRIVER_MEMORY`` or 4g, which fits
    a 7 GB container.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory",
                driver_memory or os.environ.get("RASTERPREP_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(cores: int, executors: int) -> int:
    """The converter's shuffle partition count, cores x executors x 4."""
    return int(cores) * int(executors) * 4
