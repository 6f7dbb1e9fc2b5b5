"""Replay a batch table as an ordered file stream, and run a streaming query
to completion into a file sink.

The replay deals the rows into chunks by ranges of an arrival-order column in one
distributed write, then appends chunk after chunk to the stream's folder, each by
as many writers as its size asks for.  File modification times -- the order
in which the file source reads -- follow the arrival order, and every chunk has
the same number of files, so one trigger reads exactly one chunk.  One final
sentinel row far in the future advances the watermark past every window so
append-mode operators flush (a finite file is "end of stream"); callers drop
the sentinel key from the output.  Every path lives under the shared
checkpoint folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from eventide.session import input_bytes, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# bytes of staged rows that one writer of a chunk appends; at least MIN_FILES writers share a chunk
FILE_BYTES = 128 << 20
MIN_FILES = 2
PACKED = {"parquet": {"compression": "zstd"}}  # rows are written twice, staged and appended


class Replay(NamedTuple):
    """A stream's folder and the number of files that hold one chunk."""
    folder: str
    files: int


def _file_count(spark: SparkSession, folder: str) -> int:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(1 for f in fs.listStatus(path) if f.getPath().getName().startswith("part-")) if fs.exists(path) else 0


def _append_chunk(part: DataFrame, folder: str, files: int, fmt: str) -> None:
    """Append ``part`` by at most ``files`` writers, each of some of its staged files, so that nothing is shuffled; writers
    without rows leave no file, empty ones make up the number."""
    spark = part.sparkSession
    due = _file_count(spark, folder) + files
    part.coalesce(files).write.options(**PACKED.get(fmt, {})).mode("append").format(fmt).save(folder)
    for _ in range(due - _file_count(spark, folder)):
        spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").format(fmt).save(folder)


def write_replay(df: DataFrame, order_col: str, *, chunks: int = 4, files_per_chunk: int | None = None,
                 sentinel: DataFrame | None = None, folder: str | None = None, fmt: str = "parquet",
                 write_cols: list[str] | None = None) -> Replay:
    """Write ``df`` as ``chunks`` arrival-ordered file groups (+ the sentinel);
    ``write_cols`` limits what is written (e.g. the line of a text replay).
    The source is scanned once for its rows (and once for two numbers of one
    column); a row without ``order_col`` is in the first chunk."""
    spark = df.sparkSession
    folder, staged = folder or scratch_path(spark, "replay"), scratch_path(spark, "replay-rows")
    cols = write_cols or df.columns
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    width = 1 if lo is None else (hi - lo) // chunks + 1
    no = F.lit(0) if lo is None else F.coalesce(F.floor((F.col(order_col) - lo) / width), F.lit(0)).cast("int")
    df.select(*cols, no.alias("_chunk")).write.partitionBy("_chunk").options(**PACKED["parquet"]).parquet(staged)
    files = files_per_chunk or max(MIN_FILES, -(-input_bytes(spark, staged) // (chunks * FILE_BYTES)))
    rows = spark.read.schema(StructType([*df.select(*cols).schema.fields, StructField("_chunk", IntegerType())])).parquet(staged)
    for i in range(chunks):
        _append_chunk(rows.filter(F.col("_chunk") == i).select(*cols), folder, files, fmt)
    if sentinel is not None:
        _append_chunk(sentinel.select(*cols), folder, files, fmt)
    return Replay(folder, files)


def read_replay(spark: SparkSession, replay: Replay, schema) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(replay.files))
            .parquet(replay.folder))


def run_to_parquet(stream: DataFrame, output_mode: str = "append",
                   configure: Callable | None = None, folder: str | None = None) -> DataFrame:
    """Run a streaming query over everything available, into a Parquet sink in
    the shared folder (exactly once via its checkpoint); return the result as
    a batch DataFrame read back from the sink."""
    spark = stream.sparkSession
    out, ckpt = folder or scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    w = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode(output_mode)
    if configure:
        w = configure(w)
    q: StreamingQuery = w.trigger(availableNow=True).start(out)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(out)


def use_rocksdb(spark: SparkSession) -> None:
    """State for ``transformWithState`` lives in RocksDB (spills to disk)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
