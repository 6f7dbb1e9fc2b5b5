"""Time and count windows.

Sliding windows copy every row into ``size/slide`` windows *before* the partial
aggregate (12x for 1 h/5 min, 720x for 1 h/5 s).  For decomposable aggregates
(count/sum/min/max) we first aggregate into panes of width
``gcd(size, slide, offset)`` per key -- a partial aggregate, so hot keys are
pre-reduced map-side -- and only then fan the panes out to their windows.

Where a window spans more than ``FAN_OUT`` panes, panes are not fanned out: time is divided into blocks of one window
length, and a window is the end of one block and the beginning of the next.  A pane goes to its own
block and to the next one (2 rows, not 720); there running aggregates from the left and from the right give both parts,
they change only where a pane enters or leaves, and the windows between two changes are made from one merged value.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.operators import ordered

_AGG = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400}


def duration_seconds(d: str | int) -> int:
    """'5 minutes' -> 300; plain ints are seconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", d.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported duration {d!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def _secs(s: int) -> str:
    return f"{int(s)} seconds"


def window_columns(w: str = "window") -> list[Column]:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


FAN_OUT = 16


class UserAggregate:
    """A user's own decomposable aggregate: ``partial`` maps names to aggregates over rows, ``merge`` maps the same names to
    aggregates over partial values of those names, ``result`` is a column of the merged values."""

    def __init__(self, partial: dict[str, Column], merge: dict[str, Column], result: Column):
        if set(partial) != set(merge):
            raise ValueError("partial and merge must name the same values")
        self.partial, self.merge, self.result = partial, merge, result


def _as_user(name: str, kind: str, col: Column) -> UserAggregate:
    v = f"_p_{name}"
    merged = F.col(v).cast("bigint") if kind == "count" else F.col(v)
    return UserAggregate({v: _AGG[kind](col)}, {v: _MERGE[kind](v)}, merged)


def window_aggregate(df: DataFrame, keys: Sequence[str], ts: str, size, slide=None, offset=None,
                     aggs: Sequence[tuple] | None = None, *, panes: bool = True, fan_out: int = FAN_OUT) -> DataFrame:
    """Keyed (or, with no keys, global) tumbling/sliding window aggregate.

    ``aggs`` = ``[(out, kind, column)]``, kind in count/sum/min/max, or
    ``[(out, UserAggregate)]``.  Output: ``keys..., window_start, window_end,
    outs...``; windows without rows do not appear.  ``panes`` pre-aggregates per
    pane when the window slides; windows of more than ``fan_out`` panes are put together from two blocks.
    """
    every = {a[0]: a[1] if len(a) == 2 else _as_user(*a) for a in aggs or [("cnt", "count", F.lit(1))]}
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    off_s = duration_seconds(offset) if offset is not None else 0
    win = lambda c: F.window(c, _secs(size_s), _secs(slide_s), _secs(off_s))
    partial = [c.alias(n) for u in every.values() for n, c in u.partial.items()]
    results = [u.result.alias(n) for n, u in every.items()]
    if not panes or slide_s == size_s:
        out = df.groupBy(*keys, win(F.col(ts)).alias("window")).agg(*partial)
    elif size_s // math.gcd(size_s, slide_s) > fan_out:
        return _from_blocks(df, keys, ts, size_s, slide_s, off_s, every)
    else:
        pane = math.gcd(math.gcd(size_s, slide_s), off_s) if off_s else math.gcd(size_s, slide_s)
        pane_ts = F.window(F.col(ts), _secs(pane), _secs(pane), _secs(off_s % pane)).start
        pre = df.groupBy(*keys, pane_ts.alias("_pane")).agg(*partial)
        out = pre.groupBy(*keys, win(F.col("_pane")).alias("window")).agg(
            *[c.alias(n) for u in every.values() for n, c in u.merge.items()])
    return out.select(*keys, *window_columns(), *results)


def _from_blocks(df: DataFrame, keys: Sequence[str], ts: str, size_s: int, slide_s: int, off_s: int, every: dict[str, UserAggregate]) -> DataFrame:
    """``window_aggregate`` from prefixes and suffixes of blocks of one window length.

    Block g is the panes g * per .. g * per + per - 1.  The window that ends with pane g * per + r is the panes of block
    g - 1 at places above r and those of block g at places up to r; so in group g, place by place, panes of the block
    enter and panes of the block before leave."""
    pane = math.gcd(size_s, slide_s)
    per, step = size_s // pane, slide_s // pane
    partial = {n: c for u in every.values() for n, c in u.partial.items()} | {"_panes": F.lit(1)}
    merge = {n: c for u in every.values() for n, c in u.merge.items()} | {"_panes": F.sum("_panes")}
    number = F.floor((epoch_micros(ts) - off_s * 1_000_000) / F.lit(pane * 1_000_000)).cast("bigint")
    pre = (df.filter(F.col(ts).isNotNull()).groupBy(*keys, number.alias("_pane")).agg(*[c.alias(n) for n, c in partial.items() if n != "_panes"])
           .withColumn("_panes", F.lit(1).cast("bigint")))
    place = F.pmod("_pane", F.lit(per))
    d = pre.withColumn("_at", place.cast("int")).withColumn("_block", ((F.col("_pane") - place) / per).cast("bigint"))
    # one row enters, the other leaves
    d = d.select(*keys, "_at", *merge, F.explode(F.array(F.lit(0), F.lit(1))).alias("_old"), "_block").withColumn("_block", F.col("_block") + F.col("_old"))
    up, down = (Window.partitionBy(*keys, "_block").orderBy(o) for o in (F.col("_at").asc(), F.col("_at").desc()))
    sides = {"_new_": (0, up.rangeBetween(Window.unboundedPreceding, 0)), "_rest_": (1, down.rangeBetween(Window.unboundedPreceding, -1)),
             "_all_": (1, down.rangeBetween(Window.unboundedPreceding, 0))}
    d = d.withColumnsRenamed({n: f"_in_{n}" for n in merge})
    for side, (old, frame) in sides.items():
        d = d.withColumns({n: F.when(F.col("_old") == old, F.col(f"_in_{n}")) for n in merge})
        d = d.withColumns({side + n: c.over(frame) for n, c in merge.items()})
    d = d.withColumn("_next", F.coalesce(F.lead("_at").over(up), F.lit(per))).withColumn("_first", F.lag("_at").over(up).isNull())
    value = lambda lo, hi, side: F.struct(lo.alias("_lo"), hi.alias("_hi"), *[F.col(side + n).alias(n) for n in merge])
    at, nothing = F.col("_at"), F.lit(0)
    parts = F.array(value(at, F.col("_next"), "_new_"), value(at, F.col("_next"), "_rest_"),
                    value(nothing, F.when(F.col("_first"), at).otherwise(nothing), "_all_"))
    some = F.filter(parts, lambda x: (x["_lo"] < x["_hi"]) & (x["_panes"] > 0))
    runs = d.select(*keys, "_block", F.explode(some).alias("_x")).select(*keys, "_block", "_x.*")
    runs = runs.groupBy(*keys, "_block", "_lo", "_hi").agg(*[c.alias(n) for n, c in merge.items()])
    first = F.col("_block") * per + F.col("_r") - (per - 1)  # the window's first pane
    out = runs.withColumn("_r", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1))).withColumn("_start", first)
    out = out.filter(F.pmod("_start", F.lit(step)) == 0)
    when = lambda pane_no: F.timestamp_micros(pane_no * pane * 1_000_000 + off_s * 1_000_000).cast(df.schema[ts].dataType)
    return out.select(*keys, when(F.col("_start")).alias("window_start"), when(F.col("_start") + per).alias("window_end"),
                      *[u.result.alias(n) for n, u in every.items()])


def session_aggregate(df: DataFrame, keys: Sequence[str], ts: str, gap, order: Sequence[str],
                      aggs: Sequence[tuple[str, str, Column]] | None = None) -> DataFrame:
    """W8 (batch): session windows, rows at most ``gap`` apart merge (equal
    counts as merged); session end = last row + gap, as ``session_window``.

    Gaps-and-islands on the skew-safe primitives: previous row per key, a
    running count of session starts as session id, then a partial aggregate
    per (key, session) -- no key is ever held by one task.
    """
    aggs = aggs or [("cnt", "count", F.lit(1))]
    gap_s = duration_seconds(gap)
    # only what later steps read goes through the passes
    narrow = df.select(*dict.fromkeys([*keys, *order, ts]), *[c.alias(f"_in_{n}") for n, _, c in aggs])
    cuts = ordered.cuts(narrow, keys, epoch_micros(ts))
    d = cuts.stage(ordered.lag(narrow, keys, order, cuts, {"_prev_ts": (ts, 1)}))
    start = F.col("_prev_ts").isNull() | (
        F.col(ts) > F.col("_prev_ts") + F.expr(f"INTERVAL {gap_s} SECONDS"))
    d = d.withColumn("_start", F.when(start, F.lit(1)).otherwise(F.lit(0)))
    d = ordered.running(d, keys, order, cuts, [("_sid", "sum", F.col("_start"))])
    return (d.groupBy(*keys, "_sid")
            .agg(F.min(ts).alias("window_start"),
                 (F.max(ts) + F.expr(f"INTERVAL {gap_s} SECONDS")).alias("window_end"),
                 *[_AGG[k](f"_in_{n}").alias(n) for n, k, _ in aggs])
            .drop("_sid"))


def count_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                 slide: int | None = None,
                 aggs: Sequence[tuple[str, str, Column]] | None = None,
                 *, slice_col: Column) -> DataFrame:
    """Count windows over the rows of a key (no keys: all rows).

    Tumbling (``slide`` None): rows ``(g*size, (g+1)*size]`` of the key; the
    incomplete tail never fires.  Sliding: fires at every ``slide``-th row and
    covers its last ``<= size`` rows.  Position = skew-safe running count; rows
    are then pre-aggregated in blocks of ``gcd(size, slide)`` and blocks fanned
    out to the windows that contain them.  Output ``keys..., end_pos, outs...``.
    """
    aggs = aggs or [("cnt", "count", F.lit(1))]
    pos = ordered.running(df, keys, order, slice_col, [("_pos", "count", F.lit(1))])
    if slide is None:
        block = size
        pre = pos.groupBy(*keys, F.floor((F.col("_pos") - 1) / block).alias("_b")).agg(
            F.count(F.lit(1)).alias("_n"), *[_AGG[k](c).alias(n) for n, k, c in aggs])
        return (pre.filter(F.col("_n") == block)
                .select(*keys, ((F.col("_b") + 1) * block).cast("bigint").alias("end_pos"),
                        *[n for n, _, _ in aggs]))
    block = math.gcd(size, slide)
    per = size // block
    pre = pos.groupBy(*keys, F.floor((F.col("_pos") - 1) / block).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), *[_AGG[k](c).alias(f"_p_{n}") for n, k, c in aggs])
    # block b holds rows (b*block, (b+1)*block]; the window ending at row e
    # (e a multiple of slide) holds blocks e/block - per .. e/block - 1.
    fan = pre.withColumn("_e", F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + per)))
    fan = fan.filter((F.col("_e") * block) % slide == 0)
    out = fan.groupBy(*keys, "_e").agg(
        F.sum("_n").alias("_rows"), F.max(F.col("_b")).alias("_lastb"),
        F.max(F.when(F.col("_b") == F.col("_e") - 1, F.col("_n"))).alias("_lastn"),
        *[_MERGE[k](f"_p_{n}").alias(n) for n, k, _ in aggs])
    # fires only when row e exists, i.e. its block is complete
    out = out.filter((F.col("_lastb") == F.col("_e") - 1) & (F.col("_lastn") == block))
    return out.select(*keys, (F.col("_e") * block).cast("bigint").alias("end_pos"),
                      *[n for n, _, _ in aggs])


def with_window(df: DataFrame, ts: str, size, slide=None, offset=None) -> DataFrame:
    """Attach every window that contains the row (W10 metadata, no aggregate)."""
    size_s = duration_seconds(size)
    slide_s = duration_seconds(slide) if slide is not None else size_s
    off_s = duration_seconds(offset) if offset is not None else 0
    w = F.window(F.col(ts), _secs(size_s), _secs(slide_s), _secs(off_s))
    return df.withColumn("_w", w).select("*", *window_columns("_w")).drop("_w")
