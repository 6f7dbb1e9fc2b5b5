"""File sinks: delimited files (S7) and time-bucketed rolling files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKET = "bucket"


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", mode: str = "overwrite") -> None:
    """Header-less delimited text, one file per partition."""
    df.write.mode(mode).option("sep", sep).option("header", "false").csv(path)


def _bucketed(df: DataFrame, ts: str, fmt: str) -> DataFrame:
    return df.withColumn(BUCKET, F.date_format(F.col(ts), fmt))


def write_rolling(df: DataFrame, path: str, ts: str, *, fmt: str = "yyyy-MM-dd--HH",
                  mode: str = "overwrite") -> None:
    """S8 (batch): rows rolled into one folder per time bucket of ``ts``.

    A rebalance by bucket: adaptive execution packs small buckets into one task
    and splits a bucket that holds a third of the rows over several, both by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a bucket has as few
    files as its size asks for."""
    b = _bucketed(df, ts, fmt).hint("rebalance", BUCKET)
    b.write.mode(mode).partitionBy(BUCKET).option("header", "false").csv(path)


def stream_rolling_files(df: DataFrame, path: str, checkpoint: str, ts: str, *,
                         fmt: str = "yyyy-MM-dd--HH", trigger: dict | None = None) -> StreamingQuery:
    """S8 (stream): append-only file sink, one folder per time bucket, exactly
    once through the checkpoint."""
    w = (_bucketed(df, ts, fmt).writeStream.format("csv").option("header", "false")
         .option("checkpointLocation", checkpoint).partitionBy(BUCKET).outputMode("append"))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start(path)
