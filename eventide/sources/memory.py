"""In-memory collection source (small driver-side lists only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def rows_to_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Typed rows from a driver-side collection; for fixtures and lookups only --
    everything that grows with the data comes from a distributed source."""
    return spark.createDataFrame(rows, schema=schema)
