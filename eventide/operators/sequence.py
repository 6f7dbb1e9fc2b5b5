"""Sequence detection (Q1-Q7) on the skew-safe ordered primitives.

All rules are defined on event time with arrival order (``seq``) breaking
ties, so results do not depend on how rows were batched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.operators import ordered


def _iv(seconds: float) -> Column:
    return F.expr(f"INTERVAL {int(round(seconds * 1_000_000))} MICROSECONDS")


def repeated_failures(df: DataFrame, key: str, ts: str, seq: str, is_fail: Column, *,
                      n: int = 2, check_after: float = 2.0) -> DataFrame:
    """Q1: every failure ``f`` schedules a check at ``f.ts + check_after``.  It
    warns iff no success of the key comes after ``f`` (in (ts, seq) order) with
    ``ts <= f.ts + check_after``, and the failures of its run (failures since
    the last success) with ``ts <= f.ts + check_after`` number at least ``n``.

    One running count gives every row the successes up to it; then a sweep lets every failure ask, at its deadline,
    for the counts and the run that stand there.  A failure is two rows of the sweep, whatever ``check_after`` is.

    Output: ``key, first_fail_ts`` (first failure of the run), ``fail_ts``,
    ``fail_count``.  A failure without a time asks nothing.
    """
    d = df.select(key, ts, seq, is_fail.alias("_fail"))  # only what the passes read goes through them
    cuts = ordered.cuts(d, [key], epoch_micros(ts))
    fail, success = F.when(F.col("_fail"), F.lit(1)), F.when(~F.col("_fail"), F.lit(1))
    d = cuts.stage(ordered.running(d, [key], [ts, seq], cuts, [("_f_incl", "count", fail), ("_s_incl", "count", success)]))
    # max over (successes so far, -ts of a failure): the latest run wins, and
    # inside it the earliest failure -- the first failure of the current run
    run_first = F.struct(F.col("_s_incl"), F.when(F.col("_fail"), -F.unix_micros(F.col(ts).cast("timestamp"))))
    d = d.withColumn("_fail_ts", F.col(ts)).withColumn("_s_then", F.col("_s_incl"))
    at = ordered.read_ahead(d, [key], ts, [seq], check_after, cuts, [
        ("_g", "count", fail), ("_s", "count", success), ("_f_before_run", "max", F.when(~F.col("_fail"), F.col("_f_incl"))),
        ("_run_first", "max", run_first)], asks=F.col("_fail"), keep=["_fail_ts", "_s_then"])
    first = F.timestamp_micros(-F.col("_run_first.col2")).cast(df.schema[ts].dataType)
    cnt = F.col("_g") - F.coalesce(F.col("_f_before_run"), F.lit(0))
    return (at.filter((F.col("_s") == F.col("_s_then")) & (cnt >= n))
            .select(key, first.alias("first_fail_ts"), F.col("_fail_ts").alias("fail_ts"), cnt.cast("bigint").alias("fail_count")))


def consecutive_pair(df: DataFrame, key: str, ts: str, seq: str, is_fail: Column, *,
                     within: float = 2.0) -> DataFrame:
    """Q2: in arrival order, a failure right after a failure (no success in
    between) with ``ts - prev.ts <= within`` warns at once; negative gaps pass.
    Output ``key, first_fail_ts, fail_ts``."""
    d = df.withColumn("_fail", is_fail)
    d = ordered.lag(d, [key], [seq], F.col(seq),
                    {"_pf": ("_fail", 1), "_pts": (ts, 1)})
    return (d.filter(F.col("_fail") & F.coalesce(F.col("_pf"), F.lit(False))
                     & (F.col(ts) <= F.col("_pts") + _iv(within)))
            .select(key, F.col("_pts").alias("first_fail_ts"), F.col(ts).alias("fail_ts")))


def strict_sequence(df: DataFrame, key: str, ts: str, seq: str, steps: Sequence[tuple[str, Column]], *,
                    within: float) -> DataFrame:
    """Strictly consecutive rows (event-time order) matching ``steps``
    one after another, last minus first ``< within``; every overlapping match
    is reported.  Output ``key`` and ``<step>_ts`` per step."""
    k = len(steps)
    d = df
    for i, (name, cond) in enumerate(steps):
        d = d.withColumn(f"_m{i}", cond)
    lags = {}
    for back in range(1, k):
        lags[f"_ts_b{back}"] = (ts, back)
        for i in range(k - back):
            lags[f"_m{i}_b{back}"] = (f"_m{i}", back)
    d = ordered.lag(d, [key], [ts, seq], epoch_micros(ts), lags)
    # step i sits (k-1-i) rows back from the last row
    ok = F.col(f"_m{k - 1}")
    for i in range(k - 1):
        ok = ok & F.coalesce(F.col(f"_m{i}_b{k - 1 - i}"), F.lit(False))
    first_ts = F.col(f"_ts_b{k - 1}")
    ok = ok & (F.col(ts) < first_ts + _iv(within))
    outs = [F.col(f"_ts_b{k - 1 - i}").alias(f"{name}_ts") for i, (name, _) in enumerate(steps[:-1])]
    return d.filter(ok).select(key, *outs, F.col(ts).alias(f"{steps[-1][0]}_ts"))


def followed_by(df: DataFrame, keys: Sequence[str], ts: str, seq: str, is_start: Column, is_end: Column, *,
                within: float, timeouts: bool = False) -> DataFrame:
    """Q4 / Q5: ``start followedBy end within``: every start row is matched to
    the first later end row of its key (relaxed contiguity); it matches iff
    ``end.ts < start.ts + within``.  With ``timeouts`` the unmatched starts are
    kept as ``timeout`` at ``start.ts + within`` (Q5), otherwise dropped (Q4).
    Output ``keys, start_ts, end_ts, outcome[, timeout_at]``."""
    d = df.withColumn("_st", is_start).withColumn("_en", is_end)
    nxt = F.when(F.col("_en"), F.struct(F.col(ts).alias("t"), F.col(seq).alias("s")))
    d = d.filter(F.col("_st") | F.col("_en"))
    d = ordered.running(d, keys, [ts, seq], epoch_micros(ts),
                        [("_next", "min", nxt)], exclusive=True, descending=True)
    d = d.filter(F.col("_st"))
    matched = F.col("_next").isNotNull() & (F.col("_next.t") < F.col(ts) + _iv(within))
    out = d.select(*keys, F.col(ts).alias("start_ts"),
                   F.when(matched, F.col("_next.t")).alias("end_ts"),
                   F.when(matched, F.lit("paid")).otherwise(F.lit("timeout")).alias("outcome"),
                   F.when(~matched, F.col(ts) + _iv(within)).alias("timeout_at"))
    return out if timeouts else out.filter(F.col("outcome") == "paid").drop("timeout_at")


def jumps(df: DataFrame, key: str, order: Sequence[str], value: str, threshold: float,
          slice_col: Column) -> DataFrame:
    """Q6: ``|value - previous value| >= threshold`` per key -> (key, prev, cur)."""
    d = ordered.lag(df, [key], order, slice_col, {"prev_value": (value, 1)})
    return d.filter(F.col("prev_value").isNotNull() & (F.abs(F.col(value) - F.col("prev_value")) >= threshold))


def rising_alerts(df: DataFrame, key: str, ts: str, seq: str, value: str, interval: float) -> DataFrame:
    """Q7: a rise (value > previous value of the key) starts a timer of
    ``interval``; any non-rising row cancels it.  Alert iff the first
    non-rising row after the rise's start comes later than start + interval
    (or never).  Output ``key, rise_start_ts, alert_ts``."""
    order = [ts, seq]
    narrow = df.select(*dict.fromkeys([key, ts, seq, value]))
    cuts = ordered.cuts(narrow, [key], epoch_micros(ts))
    d = cuts.stage(ordered.lag(narrow, [key], order, cuts, {"_p1": (value, 1), "_p2": (value, 2)}))
    rising = F.col("_p1").isNotNull() & (F.col(value) > F.col("_p1"))
    prev_rising = F.col("_p2").isNotNull() & (F.col("_p1") > F.col("_p2"))
    d = d.withColumn("_rise", rising).withColumn("_start", rising & ~prev_rising)
    d = ordered.running(d, [key], order, cuts, [("_next_break", "min", F.when(~F.col("_rise"), F.col(ts)))],
                        exclusive=True, descending=True)
    alert_at = F.col(ts) + _iv(interval)
    return (d.filter(F.col("_start") & (F.col("_next_break").isNull() | (F.col("_next_break") > alert_at)))
            .select(key, F.col(ts).alias("rise_start_ts"), alert_at.alias("alert_ts")))
