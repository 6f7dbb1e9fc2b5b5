"""Declarative streaming forms of the batch operators (append mode with
watermarks).  They give the same rows as the batch forms once the stream has
been flushed past the last window (see ``replay``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import duration_seconds


def event_time(df: DataFrame, ts: str = "ts", delay="0 seconds", name: str = "ets") -> DataFrame:
    """L1/L2: TIMESTAMP event-time column with a bounded-disorder watermark
    (``0 seconds`` = ascending timestamps); an unreadable delay is an error."""
    d = duration_seconds(delay)
    return df.withColumn(name, F.col(ts).cast("timestamp")).withWatermark(name, f"{d} seconds")


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def window_count_stream(df: DataFrame, keys: Sequence[str], size, slide=None, *, ets: str = "ets",
                        name: str = "cnt") -> DataFrame:
    """A5/W1/W2 (stream): keyed window counts, emitted once per window when the
    watermark passes its end."""
    return window_agg_stream(df, keys, size, slide, aggs=[F.count(F.lit(1)).alias(name)], ets=ets)


def window_agg_stream(df: DataFrame, keys: Sequence[str], size, slide=None, offset=None, *,
                      aggs: Sequence[Column], ets: str = "ets") -> DataFrame:
    """A6-A8, W1-W4, W9 (stream): any aggregates per (keys, window) in append
    mode; output ``keys, window_start, window_end, aggs``."""
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    off_s = duration_seconds(offset) if offset is not None else 0
    g = df.groupBy(*keys, F.window(ets, f"{size_s} seconds", f"{slide_s} seconds", f"{off_s} seconds").alias("w"))
    out = g.agg(*aggs)
    names = [c for c in out.columns if c not in (*keys, "w")]
    return out.select(*keys, _ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
                      *names)


def topn_stream(df: DataFrame, key: str, size, slide, n: int, *, ets: str = "ets", buckets: int = 64) -> DataFrame:
    """K1 (stream): window counts per key, then the top ``n`` of each hash
    bucket of a window's keys, then the top ``n`` of the buckets' tops.
    ``row_number`` is not allowed on streams; sorting the (count, key) pairs of
    one bucket is, and the last step holds ``n * buckets`` pairs at most, however
    many keys a window has."""
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    counts = (df.groupBy(F.window(ets, f"{size_s} seconds", f"{slide_s} seconds").alias("w"), key)
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.window_time("w").alias("wt"), F.col("w.end").alias("we"), key, "cnt",
                      F.pmod(F.xxhash64(key), F.lit(buckets)).alias("b")))
    best = lambda pair: F.slice(F.sort_array(F.collect_list(pair)), 1, n)
    some = counts.groupBy("wt", "we", "b").agg(
        best(F.struct((-F.col("cnt")).alias("neg"), F.col(key).alias("k"))).alias("top")).select("wt", "we", F.explode("top").alias("x"))
    top = some.groupBy("wt", "we").agg(best(F.col("x")).alias("top"))
    return top.select(_ntz(F.col("we")).alias("window_end"), F.posexplode("top").alias("pos", "x")).select(
        "window_end", F.col("x.k").alias(key), (-F.col("x.neg")).alias("cnt"),
        (F.col("pos") + 1).cast("bigint").alias("rank"))


def distinct_count_stream(df: DataFrame, value: str, size, *, ets: str = "ets") -> DataFrame:
    """A9 (stream): exact distinct per window.  ``count(distinct)`` is not
    allowed on streams, so: distinct (window, value) pairs first, then a
    chained count per window -- both are bounded aggregates."""
    size_s = duration_seconds(size)
    pairs = (df.groupBy(F.window(ets, f"{size_s} seconds").alias("w"), value).agg(F.count(F.lit(1)).alias("_n"))
             .select(F.window_time("w").alias("wt"), F.col("w.start").alias("ws"), F.col("w.end").alias("we")))
    return pairs.groupBy("wt", "ws", "we").agg(F.count(F.lit(1)).alias("uv")).select(
        _ntz(F.col("ws")).alias("window_start"), _ntz(F.col("we")).alias("window_end"), "uv")
