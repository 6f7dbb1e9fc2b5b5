"""Shared pieces of the training-data operators.

Words everywhere are maximal runs of characters outside U+0020 and U+0009..U+000D;
``bytes.split()`` cuts at exactly these, so Python tasks work on UTF-8 bytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import checkpoint_root, input_bytes, materialize, ship_package
from eventide.sources.tables import load_table

__all__ = ["ORACLES", "QUERIES", "SPACE", "WORD", "bounded_batches", "by_value", "fresh", "keyed_texts", "load_table", "materialize", "prepare",
           "query", "shuffle_width", "text_key", "texts"]

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its DuckDB oracle where SQL can say it."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on: UTC, the shared folder, shipped code, small Arrow batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    checkpoint_root(spark)
    ship_package(spark)


def by_value(module_name: str) -> None:
    """Pickle a module's functions by value, so Python workers need no import path of ours."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text): the two columns an operator reads; null text is empty, further columns are not carried."""
    return df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """As ``texts``, with a row key for _id: the id and a 64-bit hash of the text.  Rows that share an id (or have
    none) are told apart by their texts; rows equal in both are alike in every result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text")).alias("_id"), text.alias("_text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``df`` has it: what an operator adds never hides a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def text_key(text: Column) -> Column:
    """SHA-256 of a text, null as empty: what depends on the text alone travels by it, whatever ids a row has."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def shuffle_width(df: DataFrame, bytes_each: int = 8 << 20) -> int:
    """Partitions for data that grows with the input: one for each ``bytes_each`` of input files, and no
    fewer than the session's own number.  Inputs that come from no file (tests) take the session's number."""
    spark = df.sparkSession
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = df.inputFiles()
    if not files:
        return own
    folders = sorted({f.rsplit("/", 1)[0] if "/part-" in f else f for f in files})
    return max(own, math.ceil(input_bytes(spark, folders) / bytes_each))


def bounded_batches(rows: Iterator, size: Callable[[object], int], most: int) -> Iterator[list]:
    """Lists of consecutive items whose sizes add up to about ``most`` at the most (one item may be larger)."""
    held, total = [], 0
    for r in rows:
        n = size(r)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(r)
        total += n
    if held:
        yield held
