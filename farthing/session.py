"""Session helpers.

The library never builds a session for its callers; these helpers exist for
tests, the benchmark and the query registry.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "farthing", cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session with the settings the results rely on (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day bins are UTC days, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
