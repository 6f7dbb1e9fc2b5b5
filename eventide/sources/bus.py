"""Message-bus records.

No bus connector jar ships with this environment, so ``read_bus`` only states
the options; everything after the connector -- turning ``(key, value)`` bytes
into typed rows, or lines into ``(key, value)`` records -- is plain columns and
works on any frame with those columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.sources.parse import parse_positional


def read_bus(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
             group_id: str | None = None) -> DataFrame:
    """S6 connector: topic subscription with an offset reset policy."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load()


def bus_records_to_rows(records: DataFrame, fields: Sequence[tuple[str, str]], *, sep: str = ",",
                        trim: bool = True, on_error: str = "fail") -> DataFrame:
    """S6 parser: string form of ``value`` -> positional typed row."""
    lines = records.select(F.col("value").cast("string").alias("value"))
    return parse_positional(lines, fields, sep=sep, trim=trim, on_error=on_error)


def lines_to_bus_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """One line = one record with a null key (bulk publish shape)."""
    return lines.select(F.lit(None).cast("string").alias("key"), F.col(col).cast("string").alias("value"))
