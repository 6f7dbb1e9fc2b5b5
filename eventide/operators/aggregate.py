"""Aggregations (A1-A13): word counts, rolling reductions, window aggregates,
exact / Bloom / salted unique and page counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.hashing import bloom_offset
from eventide.functions.text import jvm_split
from eventide.operators import ordered
from eventide.session import materialize
from eventide.operators.windows import UserAggregate, duration_seconds, window_aggregate, window_columns


# ---------------------------------------------------------------- word counts
def tokens(lines: DataFrame, col: str = "line", keep: Sequence[str] = (), *, sep: str = " ",
           drop_empty: bool = False) -> DataFrame:
    """Every token of every line with its position (``pos``, 0-based)."""
    t = lines.select(*keep, F.posexplode(jvm_split(col, sep)).alias("pos", "word"))
    return t.filter(F.length("word") > 0) if drop_empty else t


def word_count(lines: DataFrame, col: str = "line", *, sep: str = " ",
               drop_empty: bool = False) -> DataFrame:
    """A1 (batch, empty tokens kept) / the final state of A2 (``drop_empty``)."""
    t = lines.select(F.explode(jvm_split(col, sep)).alias("word"))
    if drop_empty:
        t = t.filter(F.length("word") > 0)
    return t.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_word_count(toks: DataFrame, order: Sequence[str], slice_col: Column) -> DataFrame:
    """A2 batch twin: the changelog of a running word count -- for every token
    in arrival order, the word's total so far.  A hot word is split into
    slices of the arrival order, never held by one task.  The tokens are written
    once: every pass of the running count reads them, none cuts the texts again."""
    toks = materialize(toks.select(*order, "word"))
    return ordered.running(toks, ["word"], order, slice_col, [("cnt", "count", F.lit(1))])


# ------------------------------------------------------------ rolling reduces
def rolling_min_by(df: DataFrame, key: str, order: Sequence[str], value: str, slice_col: Column,
                   carry: Sequence[str] = ()) -> DataFrame:
    """A3: for every row, the whole row with the smallest ``value`` of its key
    so far; the earliest row wins ties.  Adds ``min_<col>`` for value, order
    and ``carry`` columns."""
    cols = [value, *order, *carry]
    s = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in cols]))
    out = ordered.running(df, [key], order, slice_col, [("_m", "min", s)])
    return out.select("*", *[F.col(f"_m.{c}").alias(f"min_{c}") for c in cols]).drop("_m")


def rolling_reduce(df: DataFrame, key: str, order: Sequence[str], ts: str, value: str,
                   slice_col: Column) -> DataFrame:
    """A4: reduce ``(acc, new) -> (new.ts + 1, min(acc.value, new.value))``; the
    first row of a key passes unchanged.  Adds ``red_ts``, ``red_value``."""
    out = ordered.running(df, [key], order, slice_col,
                          [("_rn", "count", F.lit(1)), ("red_value", "min", F.col(value))])
    return (out.withColumn("red_ts", F.col(ts) + F.when(F.col("_rn") > 1, F.lit(1)).otherwise(F.lit(0)))
            .drop("_rn"))


# ----------------------------------------------------------- window reductions
def window_avg(df: DataFrame, key: str, ts: str, size, value: str, slide=None) -> DataFrame:
    """Average per key and window, from a (sum, count) accumulator."""
    agg = window_aggregate(df, [key], ts, size, slide,
                           aggs=[("_s", "sum", F.col(value)), ("n", "count", F.col(value))])
    return agg.withColumn("avg_value", F.col("_s") / F.col("n")).drop("_s")


def window_max_reduce(df: DataFrame, key: str, ts_sec: str, ts: str, size, value: str,
                      seq: str) -> DataFrame:
    """Max ``value`` per key and window; timestamp = last-arrived row's + 1
    when the window holds two or more rows (a reduce never runs on one row)."""
    g = df.groupBy(key, F.window(ts, f"{duration_seconds(size)} seconds").alias("window"))
    return g.agg(F.max(value).alias("max_value"),
                 F.max_by(F.col(ts_sec), F.col(seq)).alias("_last"),
                 F.count(F.lit(1)).alias("n")).select(
        key, *window_columns(), "max_value", "n",
        (F.col("_last") + F.when(F.col("n") > 1, F.lit(1)).otherwise(F.lit(0))).alias("red_ts"))


def window_min_by(df: DataFrame, key: str, ts: str, size, value: str, order: Sequence[str],
                  carry: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest value per key and window (earliest on ties)."""
    cols = [value, *order, *carry]
    g = df.groupBy(key, F.window(ts, f"{duration_seconds(size)} seconds").alias("window"))
    m = g.agg(F.min(F.struct(*[F.col(c) for c in cols])).alias("_m"))
    return m.select(key, *window_columns(), *[F.col(f"_m.{c}").alias(f"min_{c}") for c in cols])


# ------------------------------------------------------------ unique visitors
def distinct_per_window(df: DataFrame, ts: str, size, value: str, keys: Sequence[str] = (), *,
                        relative_error: float | None = None) -> DataFrame:
    """Exact distinct ``value`` per window.  Planned as a two-level
    aggregate (distinct (window, value) pairs first), so no set is ever held
    in one place.  With ``relative_error`` a HyperLogLog estimate (A10): one
    sketch per window and map task is all that is shuffled."""
    g = df.groupBy(*keys, F.window(ts, f"{duration_seconds(size)} seconds").alias("window"))
    uv = F.count_distinct(value) if relative_error is None else F.approx_count_distinct(value, relative_error)
    return g.agg(uv.alias("uv")).select(*keys, *window_columns(), "uv")


def sketch_distinct_per_window(df: DataFrame, ts: str, size, slide, value: str, keys: Sequence[str] = (), *, bits: int = 12) -> DataFrame:
    """A9/A10 over sliding windows: distinct ``value`` by HyperLogLog sketches of 2**``bits`` registers, one per key and pane,
    merged into windows; ``keys, window_start, window_end, uv_sketch, uv_estimate``.  A value is hashed once, whatever
    the windows that hold it; a sketch can be stored and merged again.  The relative error is about 1.04 / 2**(bits / 2)."""
    sketch = UserAggregate({"_hll": F.hll_sketch_agg(F.col(value), F.lit(bits))}, {"_hll": F.hll_union_agg("_hll", F.lit(False))}, F.col("_hll"))
    out = window_aggregate(df, keys, ts, size, slide, aggs=[("uv_sketch", sketch)])
    return out.withColumn("uv_estimate", F.hll_sketch_estimate("uv_sketch"))


def bloom_distinct_per_window(df: DataFrame, ts: str, size, value: str) -> DataFrame:
    """A10 final: number of distinct Bloom bit offsets per window (one hash,
    collisions undercount, by design)."""
    g = df.groupBy(F.window(ts, f"{duration_seconds(size)} seconds").alias("window"))
    return g.agg(F.count_distinct(bloom_offset(value)).alias("uv")).select(*window_columns(), "uv")


def bloom_changelog(df: DataFrame, ts: str, size, value: str, seq: str) -> DataFrame:
    """A10 with fire-on-every-element: one output per element that sets a new
    bit, carrying the window's running count.  First arrival per (window,
    offset) is a partial aggregate; the running count inside a window is the
    skew-safe running count over arrival order."""
    w = F.window(ts, f"{duration_seconds(size)} seconds")
    first = (df.groupBy(w.alias("window"), bloom_offset(value).alias("offset"))
             .agg(F.min(seq).alias("first_seq"))
             .select(*window_columns(), "offset", "first_seq"))
    return ordered.running(first, ["window_start", "window_end"], ["first_seq"],
                           F.col("first_seq"),
                           [("uv", "count", F.lit(1))])


def salted_window_count(df: DataFrame, ts: str, size, salt_col: str, buckets: int = 16) -> DataFrame:
    """Two-phase count -- (window, salt) counts, then a sum per window.
    The salt is a hash of a row column, so retries are deterministic."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(buckets)))
    g = salted.groupBy(F.window(ts, f"{duration_seconds(size)} seconds").alias("window"), "_salt")
    phase1 = g.agg(F.count(F.lit(1)).alias("count")).select(*window_columns(), "count")
    return phase1.groupBy("window_start", "window_end").agg(F.sum("count").alias("pv"))


def sum_count_shortcut(phase1: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Phase two written with the ``GroupedData.sum('count')`` shortcut."""
    return phase1.groupBy(*keys).sum("count").withColumnRenamed("sum(count)", "pv")
