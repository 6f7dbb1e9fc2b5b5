"""Watermarks and late data, replayed deterministically on batch tables
(L1-L4, K3's corrections).

A watermark in a stream is ``max event time seen so far - bounded delay``.  For
a replay we define it per row from the arrival order: the watermark a row meets
is the running max of the event times of all rows that arrived *before* it,
minus the delay.  That is a global running max -- computed with the skew-safe
running primitive over slices of the arrival order, never one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.operators import ordered
from eventide.operators.windows import duration_seconds


def _iv(seconds: int):
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def with_watermark(df: DataFrame, ts: str, arrival: Sequence[str], delay) -> DataFrame:
    """Adds ``wm``: watermark seen by each row on arrival (null for the first)."""
    d = ordered.running(df, [], arrival, F.col(arrival[0]),
                        [("_maxts", "max", F.col(ts))], exclusive=True)
    return d.withColumn("wm", F.col("_maxts") - _iv(duration_seconds(delay))).drop("_maxts")


def route_late(df: DataFrame, ts: str, arrival: Sequence[str], delay, size, slide=None, lateness=0) -> DataFrame:
    """L4: ``channel = 'late'`` for rows every window of which is already closed
    (watermark >= window end + allowed lateness) when they arrive, otherwise
    ``'on_time'``.  Spark's own streaming operators drop such rows silently;
    this routes them instead."""
    return route_by_watermark(with_watermark(df, ts, arrival, delay), ts, size, slide, lateness)


def route_by_watermark(d: DataFrame, ts: str, size, slide=None, lateness=0, wm: str = "wm") -> DataFrame:
    """L4 routing for rows that already carry the watermark they met."""
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    # latest window containing ts ends at the first slide boundary after ts, + size - slide
    last_end = F.window(F.col(ts), f"{slide_s} seconds").end + _iv(size_s - slide_s)
    late = F.col(wm).isNotNull() & (F.col(wm) >= last_end + _iv(duration_seconds(lateness)))
    return d.withColumn("channel", F.when(late, F.lit("late")).otherwise(F.lit("on_time")))


def accepted_window_rows(df: DataFrame, ts: str, arrival: Sequence[str], delay, size, slide=None,
                         lateness=0) -> DataFrame:
    """K3/L3 replay: every (row, window) pair that the window still accepts when
    the row arrives (watermark < window end + allowed lateness).  Counting these
    per window gives the final, late-corrected window result."""
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    d = with_watermark(df, ts, arrival, delay)
    d = d.withColumn("_w", F.window(F.col(ts), f"{size_s} seconds", f"{slide_s} seconds"))
    ok = F.col("wm").isNull() | (F.col("wm") < F.col("_w.end") + _iv(duration_seconds(lateness)))
    return d.filter(ok).select("*", F.col("_w.start").alias("window_start"),
                               F.col("_w.end").alias("window_end")).drop("_w")


def accepted_window_counts(df: DataFrame, keys: Sequence[str], ts: str, arrival: Sequence[str], delay, size, slide=None,
                           lateness=0) -> DataFrame:
    """K3/L3 counts: how many rows each (keys, window) accepts; ``keys, window_start, window_end, cnt``.

    A row is in the windows that end 0, 1, ... slides after its pane, and of
    these a watermark closes the first few, so (pane, number of closed windows)
    says all: rows are counted by that before a pane is copied to its windows."""
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    if size_s % slide_s:
        raise ValueError("the size must be a multiple of the slide")
    n = size_s // slide_s
    d = with_watermark(df, ts, arrival, delay).withColumn("_p", F.window(F.col(ts), f"{slide_s} seconds").end)
    behind = epoch_micros("wm") - F.lit(duration_seconds(lateness) * 1_000_000) - epoch_micros("_p")
    closed = F.greatest(F.lit(0), F.floor(behind / F.lit(slide_s * 1_000_000)) + 1)
    d = d.withColumn("_k", F.coalesce(closed, F.lit(0)).cast("int")).filter(F.col("_k") < n)
    panes = d.groupBy(*keys, "_p", "_k").agg(F.count(F.lit(1)).alias("_n"))
    fan = panes.select(*keys, "_p", "_n", F.explode(F.sequence(F.col("_k"), F.lit(n - 1))).alias("_j"))
    end = F.col("_p") + F.make_dt_interval(secs=F.col("_j") * slide_s)
    return (fan.groupBy(*keys, end.alias("window_end")).agg(F.sum("_n").alias("cnt"))
            .select(*keys, (F.col("window_end") - _iv(size_s)).alias("window_start"), "window_end", "cnt"))
