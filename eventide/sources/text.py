"""Line sources (S1 batch, S2 stream) and lines of stored texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.text import split_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a text file or folder (column ``value``)."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, folder: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded line stream over the files arriving in ``folder``."""
    reader = spark.readStream.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every line of every text, whole: ``(doc_id, line_no, line)``; line_no is 0-based."""
    return docs.select(id_col, F.posexplode(split_lines(text_col)).alias("line_no", "line"))
