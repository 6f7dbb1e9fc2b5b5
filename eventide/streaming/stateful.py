"""Per-key stateful streaming operators on ``transformWithStateInPandas``.

Spark calls a handler with *all* rows of a key in a micro-batch and fires
timers only after the batch's rows.  To make results independent of batch
boundaries, every handler sorts its rows by (event time, arrival) and fires
the checks that are already due *inline*, before the row that passes their
deadline; event-time timers only cover deadlines that no later row reaches.
Q1, Q4/Q5, J1 and J2 have as many keys as there are users, so their keys are dealt into
hash parts (``generic.in_parts``): a handler sees all rows of a part, keeps what
is open of each of its keys in value / list / map state in RocksDB, and sets one timer for the part's
earliest deadline.  State is bounded by the open items, never by the stream.

Times cross the Python boundary as epoch microseconds (``ts_us``).
"""

from __future__ import annotations

import bisect
import heapq
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions.hashing import bloom_offset
from eventide.operators import topk
from eventide.operators.windows import duration_seconds
from eventide.streaming.generic import BUCKET_SECONDS, PART, TimeBuckets, in_parts, records
from eventide.streaming.replay import use_rocksdb


def _ms_ceil(us: int) -> int:
    return -(-int(us) // 1000)


def _sorted(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    frames = list(rows)
    df = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()
    return df.sort_values(by, kind="stable") if len(df) else df


def _ids(df: pd.DataFrame, key) -> list:
    """The key of each row: of rows without an ``id`` it is the handler's."""
    return df["id"].tolist() if "id" in df else [key[0]] * len(df)


def _rows(out: list[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """``out`` as one frame, whose longs stay whole beside nulls; nothing if it is empty."""
    if out:
        yield pd.DataFrame(out, columns=columns, dtype=object)


# ------------------------------------------------------------------ Q6 jumps
class JumpAlertProcessor(StatefulProcessor):
    """Q6: previous reading per key in value state; alert when the jump is at
    least ``threshold``."""

    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["seq"])
        prev = self.last.get()
        prev = None if prev is None else prev[0]
        out = []
        for seq, v in zip(df["seq"].tolist(), df["temperature"].tolist()):
            if prev is not None and abs(v - prev) >= self.threshold:
                out.append((key[0], seq, prev, v))
            prev = v
        if prev is not None:
            self.last.update((float(prev),))
        yield pd.DataFrame(out, columns=["id", "seq", "prev_value", "temperature"])

    def close(self) -> None:
        pass


def jumps_stream(df: DataFrame, threshold: float) -> DataFrame:
    use_rocksdb(df.sparkSession)
    return df.select("id", "seq", "temperature").groupBy("id").transformWithStateInPandas(
        statefulProcessor=JumpAlertProcessor(threshold),
        outputStructType="id string, seq long, prev_value double, temperature double",
        outputMode="Append", timeMode="None")


# ------------------------------------------------------- Q4/Q5 followed-by
class FollowedByProcessor(StatefulProcessor):
    """Q5: starts wait (list state) for the first later end row of their key; an end row
    resolves every waiting start (``paid`` iff end < start + within); a start
    still waiting when the watermark passes its deadline times out."""

    def __init__(self, within_us: int):
        self.within = within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "id string, week_us long, ts_us long")

    def _row(self, key, start, end, outcome):
        timeout_at = None if outcome == "paid" else start + self.within
        return (*key, start, end if outcome == "paid" else None, outcome, timeout_at)

    def _save(self, waiting: list[tuple]) -> None:
        self.pending.clear()
        if waiting:
            self.pending.put(waiting)
            self.handle.registerTimer(_ms_ceil(min(w[2] for w in waiting) + self.within))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["ts_us", "seq"])
        pending: dict[tuple, list[int]] = {}
        for user, week, ts in self.pending.get():
            pending.setdefault((user, week), []).append(ts)
        out = []
        for user, week, ts, is_start in records(df, ["id", "week_us", "ts_us", "is_start"]):
            if is_start:
                pending.setdefault((user, week), []).append(ts)
            else:
                for start in pending.pop((user, week), ()):
                    out.append(self._row((user, week), start, ts, "paid" if ts < start + self.within else "timeout"))
        self._save([(*own, ts) for own, starts in pending.items() for ts in starts])
        yield from _rows(out, COLS_Q5)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = timerValues.getCurrentWatermarkInMs() * 1000 - self.within  # later starts have time left
        waiting = [tuple(w) for w in self.pending.get()]
        due = [w for w in waiting if w[2] <= last]
        if due:
            self._save([w for w in waiting if w[2] > last])
        yield from _rows([self._row(w[:2], w[2], None, "timeout") for w in due], COLS_Q5)

    def close(self) -> None:
        pass


COLS_Q5 = ["user_id", "week_us", "start_us", "end_us", "outcome", "timeout_us"]


def followed_by_stream(df: DataFrame, within_seconds: float) -> DataFrame:
    """``df``: user_id, week_start, ts, seq, is_start (boolean) + watermark on ``ets``."""
    use_rocksdb(df.sparkSession)
    x = df.filter(F.col("ts").isNotNull()).select(
        F.col("user_id").alias("id"), F.unix_micros(F.col("week_start").cast("timestamp")).alias("week_us"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "seq", "is_start", "ets")
    out = in_parts(x, ["id"]).groupBy(PART).transformWithStateInPandas(
        statefulProcessor=FollowedByProcessor(int(within_seconds * 1_000_000)),
        outputStructType="user_id string, week_us long, start_us long, end_us long, outcome string, timeout_us long",
        outputMode="Append", timeMode="EventTime")
    ts = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return out.select(F.col("user_id").cast(df.schema["user_id"].dataType).alias("user_id"), ts("week_us").alias("week_start"), ts("start_us").alias("start_ts"),
                      ts("end_us").alias("end_ts"), "outcome", ts("timeout_us").alias("timeout_at"))


# ------------------------------------------------- Q1 repeated failures
class RepeatedFailureProcessor(StatefulProcessor):
    """Q1: each failure is checked ``check_after`` later: it warns iff no success came in between
    and at least ``n`` failures of the run are at or before its deadline.  State: for each key the run's first
    failure and how many of its failures are checked already, and the times of those that wait, in order -- so what is
    due lies in front and a count is a position."""

    def __init__(self, n: int, check_us: int):
        self.n, self.check = n, check_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "doc string")
        self.waiting = handle.getListState("waiting", "id string, ts_us long")

    def _load(self) -> dict:
        """{key: [first failure, checked, place of the next to check, times from there on]} of the open runs."""
        got = self.runs.get()
        runs = {own: [first, checked, 0, []] for own, first, checked in (json.loads(got[0]) if got is not None else ())}
        for own, ts in self.waiting.get():
            runs[own][3].append(ts)
        return runs

    def _save(self, runs: dict) -> None:
        waiting = [(own, ts) for own, (_, _, at, times) in runs.items() for ts in times[at:]]
        if runs:
            self.runs.update((json.dumps([(own, run[0], run[1]) for own, run in runs.items()]),))
        else:
            self.runs.clear()
        self.waiting.clear()
        if waiting:
            self.waiting.put(waiting)
            self.handle.registerTimer(_ms_ceil(min(ts for _, ts in waiting) + self.check))

    def _due(self, own, run: list, upto_us, out: list) -> None:
        """Check the failures of a run whose deadline is before ``upto_us``."""
        first, checked, at, times = run
        while at < len(times) and times[at] + self.check < upto_us:
            count = checked + bisect.bisect_right(times, times[at] + self.check, at) - at
            if count >= self.n:
                out.append((own, first, times[at], count))
            at, checked = at + 1, checked + 1
        run[1:3] = checked, at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["ts_us", "seq"])
        runs, out = self._load(), []
        for own, ts, fail in zip(_ids(df, key), df["ts_us"].tolist(), df["fail"].tolist()):
            run = runs.get(own)
            if run is not None:
                self._due(own, run, ts, out)
            if not fail:  # a success cancels every pending check and ends the run
                runs.pop(own, None)
            elif run is None:
                runs[own] = [ts, 0, 0, [ts]]
            else:
                run[3].append(ts)
        self._save(runs)
        yield from _rows(out, COLS_Q1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs, out = self._load(), []
        for own, run in runs.items():
            self._due(own, run, timerValues.getCurrentWatermarkInMs() * 1000 + 1, out)
        if any(run[2] for run in runs.values()):
            self._save(runs)
        yield from _rows(out, COLS_Q1)

    def close(self) -> None:
        pass


COLS_Q1 = ["user_id", "first_us", "fail_us", "fail_count"]


def repeated_failures_stream(df: DataFrame, n: int, check_after: float) -> DataFrame:
    """``df``: user_id, ts, seq, fail (boolean) + watermark on ``ets``."""
    use_rocksdb(df.sparkSession)
    x = df.filter(F.col("ts").isNotNull()).select(
        F.col("user_id").alias("id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "seq", "fail", "ets")
    out = in_parts(x, ["id"]).groupBy(PART).transformWithStateInPandas(
        statefulProcessor=RepeatedFailureProcessor(n, int(check_after * 1_000_000)),
        outputStructType="user_id string, first_us long, fail_us long, fail_count long",
        outputMode="Append", timeMode="EventTime")
    ts = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return out.select(F.col("user_id").cast(df.schema["user_id"].dataType).alias("user_id"), ts("first_us").alias("first_fail_ts"), ts("fail_us").alias("fail_ts"), "fail_count")


# ------------------------------------------------------- J2 order outcome
class OrderOutcomeProcessor(StatefulProcessor):
    """First create and first pay per order in map state by week; the outcome is
    final when the order's lifetime ends (its ISO week), so a timer at the end
    of the week classifies and clears the orders of that week."""

    def __init__(self, limit_us: int, lifetime_us: int):
        self.limit, self.lifetime = limit_us, lifetime_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.orders = handle.getMapState("orders", "week_us long", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["ts_us", "seq"])
        for week, part in df.groupby("week_us"):
            got = self.orders.getValue((int(week),))
            first = {o[0]: o for o in json.loads(got[0])} if got is not None else {}
            if got is None:
                self.handle.registerTimer(_ms_ceil(week + self.lifetime))
            for own, ts, seq, is_create in records(part, ["id", "ts_us", "seq", "is_create"]):
                order = first.setdefault(own, [own, None, None, None, None])
                at = 1 if is_create else 3
                if order[at] is None or (ts, seq) < (order[at], order[at + 1]):
                    order[at:at + 2] = ts, seq
            self.orders.updateValue((int(week),), (json.dumps(list(first.values())),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, out = timerValues.getCurrentWatermarkInMs() * 1000 - self.lifetime, []
        for (week,) in sorted(k for k in self.orders.keys() if k[0] <= last):
            for own, c_us, _, p_us, _ in json.loads(self.orders.getValue((week,))[0]):
                if c_us is None:
                    outcome = "data-not-found"
                elif p_us is None:
                    outcome = "time-out"
                else:
                    outcome = "paid" if p_us < c_us + self.limit else "paid-but-timeout"
                out.append((own, week, outcome, c_us, p_us))
            self.orders.removeKey((week,))
        yield from _rows(out, COLS_J2)

    def close(self) -> None:
        pass


COLS_J2 = ["user_id", "week_us", "outcome", "create_us", "pay_us"]


def order_outcomes_stream(df: DataFrame, limit_seconds: float, lifetime_seconds: float = 7 * 86400) -> DataFrame:
    """``df``: user_id, week_start, ts, seq, is_create + watermark on ``ets``."""
    use_rocksdb(df.sparkSession)
    x = df.filter(F.col("ts").isNotNull()).select(
        F.col("user_id").alias("id"), F.unix_micros(F.col("week_start").cast("timestamp")).alias("week_us"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "seq", "is_create", "ets")
    out = in_parts(x, ["id"]).groupBy(PART).transformWithStateInPandas(
        statefulProcessor=OrderOutcomeProcessor(int(limit_seconds * 1_000_000), int(lifetime_seconds * 1_000_000)),
        outputStructType="user_id string, week_us long, outcome string, create_us long, pay_us long",
        outputMode="Append", timeMode="EventTime")
    ts = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return out.select(F.col("user_id").cast(df.schema["user_id"].dataType).alias("user_id"), ts("week_us").alias("week_start"), "outcome", ts("create_us").alias("create_ts"),
                      ts("pay_us").alias("pay_ts"))


# ------------------------------------------------------------ Q7 rising alert
class RisingAlertProcessor(StatefulProcessor):
    """Q7: a rise (value above the previous one) starts a timer of
    ``interval``; the first non-rising row cancels it if it comes no later than
    start + interval.  State: last value, whether the last row rose, and the
    start of the open rise (at most one per key)."""

    def __init__(self, interval_us: int):
        self.interval = interval_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("s", "last double, rising boolean, open_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["ts_us", "seq"])
        got = self.state.get()
        last, was_rising, open_us = got if got is not None else (None, False, None)
        v = df["value"].to_numpy(dtype="float64")
        ts = df["ts_us"].to_numpy(dtype="int64")
        prev = np.concatenate([[np.nan if last is None else last], v[:-1]])
        rising = v > prev  # NaN compares false: the first row of a key never rises
        prev_rising = np.concatenate([[bool(was_rising)], rising[:-1]])
        starts = np.flatnonzero(rising & ~prev_rising)
        breaks = np.flatnonzero(~rising)
        out = []
        if open_us is not None:  # a rise left open by an earlier batch
            if len(breaks) == 0:
                pass
            else:
                if ts[breaks[0]] > open_us + self.interval:
                    out.append((key[0], open_us, open_us + self.interval))
                open_us = None
        nxt = np.searchsorted(breaks, starts)  # first break after each start
        for s, b in zip(starts.tolist(), nxt.tolist()):
            if b < len(breaks):
                if ts[breaks[b]] > ts[s] + self.interval:
                    out.append((key[0], int(ts[s]), int(ts[s]) + self.interval))
            else:  # still rising at the end of the batch: wait for a break or the timer
                open_us = int(ts[s])
                self.handle.registerTimer(-(-(open_us + self.interval) // 1000))
        if len(v):
            self.state.update((float(v[-1]), bool(rising[-1]), open_us))
        yield pd.DataFrame(out, columns=["id", "start_us", "alert_us"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        got = self.state.get()
        out = []
        if got is not None and got[2] is not None and got[2] + self.interval <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            out.append((key[0], got[2], got[2] + self.interval))
            self.state.update((got[0], got[1], None))
        yield pd.DataFrame(out, columns=["id", "start_us", "alert_us"])

    def close(self) -> None:
        pass


def rising_alerts_stream(df: DataFrame, interval_seconds: float) -> DataFrame:
    """``df``: id, ts, seq, value + watermark on ``ets``."""
    use_rocksdb(df.sparkSession)
    x = df.select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "seq", "value", "ets")
    out = x.groupBy("id").transformWithStateInPandas(
        statefulProcessor=RisingAlertProcessor(int(interval_seconds * 1_000_000)),
        outputStructType="id string, start_us long, alert_us long", outputMode="Append", timeMode="EventTime")
    ts = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return out.select("id", ts("start_us").alias("rise_start_ts"), ts("alert_us").alias("alert_ts"))


# ------------------------------------------------- J1 one-to-one reconciliation
COLS_J1 = ["tx_id", "l_seq", "l_us", "r_seq", "r_us", "outcome"]


class ReconcileProcessor(StatefulProcessor):
    """Rows wait by time bucket until the watermark has passed it, so
    they are paired in event time whatever order they came in; then each key has one slot, which
    holds the row that waits for a partner.  A row pairs with the waiting one of its key if
    that is of the other side and at most ``within`` older, else it takes the slot
    and the one before goes out single -- at the latest at the end of the bucket in which its time is up."""

    def __init__(self, within_us: int, tags: tuple[str, str, str], width_us: int):
        self.within, self.tags, self.width = within_us, tags, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = TimeBuckets(handle, self.width)
        self.slot = handle.getValueState("slot", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self.held.add(frame[["ts_us", "side", "seq"]].assign(id=_ids(frame, key)), "ts_us")
        return iter(())

    def _single(self, own, row) -> tuple:
        ts, side, seq = row
        return (own, None, None, seq, ts, self.tags[2]) if side else (own, seq, ts, None, None, self.tags[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # all due buckets at once: a slot's timer must lie beyond the watermark, or nothing would fire it
        due, end = self.held.take_due(timerValues.getCurrentWatermarkInMs())
        got = self.slot.get()
        slots, out = {own: tuple(row) for own, *row in json.loads(got[0])} if got is not None else {}, []
        for *row, own in sorted(due, key=lambda r: r[:3]):
            row, wait = tuple(row), slots.get(own)
            if wait is not None and wait[1] != row[1] and row[0] - wait[0] <= self.within:
                left, right = (wait, row) if row[1] else (row, wait)
                out.append((own, left[2], left[0], right[2], right[0], self.tags[0]))
                del slots[own]
            else:
                if wait is not None:
                    out.append(self._single(own, wait))
                slots[own] = row
        for own in [own for own, row in slots.items() if row[0] + self.within < end]:
            out.append(self._single(own, slots.pop(own)))
        if slots:
            self.handle.registerTimer(self.held.end_after(min(row[0] for row in slots.values()) + self.within))
        if due or out:
            if slots:
                self.slot.update((json.dumps([(own, *row) for own, row in slots.items()]),))
            else:
                self.slot.clear()
        yield from _rows(out, COLS_J1)

    def close(self) -> None:
        pass


def reconcile_stream(left: DataFrame, right: DataFrame, key: str, *, within_seconds: float, lts: str, rts: str, lseq: str, rseq: str,
                     tags: tuple[str, str, str]) -> DataFrame:
    """J1 on two streams with watermarks on ``ets``; output as ``operators.reconcile.interval_reconcile``."""
    use_rocksdb(left.sparkSession)
    side = lambda d, no, ts, seq: d.filter(F.col(ts).isNotNull()).select(
        F.col(key).alias("id"), F.unix_micros(F.col(ts).cast("timestamp")).alias("ts_us"), F.lit(no).alias("side"),
        F.col(seq).alias("seq"), "ets")
    both = side(left, 0, lts, lseq).unionByName(side(right, 1, rts, rseq))
    out = in_parts(both, ["id"]).groupBy(PART).transformWithStateInPandas(
        statefulProcessor=ReconcileProcessor(int(round(within_seconds * 1_000_000)), tags, BUCKET_SECONDS * 1_000_000),
        outputStructType="tx_id string, l_seq long, l_us long, r_seq long, r_us long, outcome string",
        outputMode="Append", timeMode="EventTime")
    when = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return out.select(F.col("tx_id").cast(left.schema[key].dataType).alias(key), F.col("l_seq").alias(lseq), when("l_us").alias(lts), F.col("r_seq").alias(rseq),
                      when("r_us").alias(rts), "outcome")


# ---------------------------------------------- K3 / L7 / L8 late-corrected ranking
COLS_K3 = ["end_us", "part", "as_of_ms", "url", "cnt", "rank"]


class PageRankingProcessor(StatefulProcessor):
    """K3: how often each page was seen in each window, in map state (page -> counts by window end).  A report timer fires when the
    disorder's watermark passes a window's end and lists the ``n`` largest of every window that is due; a row that comes
    later corrects its entry and sets the report timer anew; the clearing timer, ``lateness`` after the last
    window's end, ends the state.

    A key is one hash part of the pages of one block of windows, so a busy window is spread over many keys and a quiet
    one shares its calls and timers with its neighbours.  Rows: ``url``, and ``end_us`` and ``n`` where the key does not name the
    window and rows are counted already."""

    def __init__(self, n: int, lateness_ms: int):
        self.n, self.lateness = n, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "url string", "doc string")
        self.open = handle.getValueState("open", "last_us long, due array<long>")  # the last window's end, ends to be reported

    def _save(self, last: int, due: set[int]) -> None:
        self.open.update((last, sorted(due)))
        if due:
            self.handle.registerTimer(min(due) // 1000 - self.lateness)
        self.handle.registerTimer(last // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True)
        df = df.assign(end_us=df["end_us"] if "end_us" in df else key[0], n=df["n"] if "n" in df else 1)
        got = self.open.get()
        last, due = (0, set()) if got is None else (got[0], set(got[1]))
        ends = set(map(int, df["end_us"].unique()))
        seen: dict[str, dict[str, int]] = {}
        for (url, end), n in df.groupby(["url", "end_us"])["n"].sum().items():
            seen.setdefault(url, {})[str(end)] = int(n)
        for url, fresh in seen.items():
            held = self.counts.getValue((url,))
            counts = json.loads(held[0]) if held is not None else {}
            counts.update({end: counts.get(end, 0) + n for end, n in fresh.items()})
            self.counts.updateValue((url,), (json.dumps(counts),))
        self._save(max(last, *ends), due | ends)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, got = timerValues.getCurrentWatermarkInMs(), self.open.get()
        if got is None:
            return
        last, due = got[0], {end for end in got[1] if end // 1000 - self.lateness <= now}
        if due:
            best: dict[int, list[tuple]] = {end: [] for end in due}
            for (url,), (doc,) in self.counts.iterator():
                for end, n in json.loads(doc).items():
                    if int(end) in due:
                        best[int(end)].append((-n, url))
            yield from _rows([(end, key[1], now, url, -n, k) for end in sorted(due) for k, (n, url) in enumerate(heapq.nsmallest(self.n, best[end]), 1)], COLS_K3)
        if last // 1000 <= now:  # rows of these windows are too late from here on
            self.counts.clear()
            self.open.clear()
        elif due:
            self._save(last, set(got[1]) - due)

    def close(self) -> None:
        pass


def counted_in_panes(df: DataFrame, key: str, ts: str, pane_seconds: int) -> DataFrame:
    """(key, ets, n): how many rows of a pane each key has in one Arrow batch, at the time of the last of them.  Windows made of whole
    panes hold all of these rows or none, and the latest time, which moves the watermark, stays.  Rows without a key or time are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = pa.Table.from_batches([b]).group_by(["key", "pane"]).aggregate([("ets", "max"), ("ets", "count")])
            yield from some.select(["key", "ets_max", "ets_count"]).rename_columns(["key", "ets", "n"]).to_batches()

    x = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("ets"))
    kind = x.schema["key"].dataType.simpleString()
    panes = x.withColumn("pane", F.floor(F.unix_micros("ets") / F.lit(pane_seconds * 1_000_000)))
    return panes.mapInArrow(run, f"key {kind}, ets timestamp, n long").withColumnRenamed("key", key)


BLOCK_WINDOWS = 6  # sizes of a window whose ends share a key


def page_ranking_stream(df: DataFrame, size, slide, n: int, *, delay_seconds: int, lateness_seconds: int, parts: int = 16) -> DataFrame:
    """``df``: url and ts of page views.  Reports (window_end, part, as_of, url, cnt, rank); the last one of a part holds.

    The watermark trails by delay + lateness, so that Spark keeps rows for windows that still take corrections; the
    report timer is set that much earlier.  Views are counted by pane before they fan out to their windows."""
    use_rocksdb(df.sparkSession)
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    counted = counted_in_panes(df, "url", "ts", math.gcd(size_s, slide_s))
    late = counted.withWatermark("ets", f"{delay_seconds + lateness_seconds} seconds")
    x = late.select(F.window("ets", f"{size_s} seconds", f"{slide_s} seconds").alias("w"), "url", "n")
    end = F.unix_micros("w.end")
    x = x.select("w", "url", "n", end.alias("end_us"), F.floor(end / F.lit(BLOCK_WINDOWS * size_s * 1_000_000)).alias("block"),
                 F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int").alias("part"))
    out = x.groupBy("block", "part").transformWithStateInPandas(
        statefulProcessor=PageRankingProcessor(n, lateness_seconds * 1000), outputStructType="end_us long, part int, as_of_ms long, url string, cnt long, rank int",
        outputMode="Append", timeMode="EventTime")
    return out.select(F.timestamp_micros("end_us").cast("timestamp_ntz").alias("window_end"), "part", "as_of_ms", "url", "cnt", "rank")


def last_ranking(reports: DataFrame, n: int) -> DataFrame:
    """The top ``n`` of every window from the last report of each of its parts."""
    last = Window.partitionBy("window_end", "part")
    now = reports.withColumn("_last", F.max("as_of_ms").over(last)).filter(F.col("as_of_ms") == F.col("_last"))
    return topk.top_n(now.select("window_end", "url", "cnt"), ["window_end"], [F.col("cnt").desc(), F.col("url")], n)


# ------------------------------------------------------- A10b / L5 fire on every element
COLS_A10 = ["start_us", "offset", "first_seq", "uv"]


class BloomChangelogProcessor(StatefulProcessor):
    """A10 fired on every element: the bitmap of a window's Bloom offsets in map state, 64 bits an entry; an element that sets
    a bit goes out with the number of bits set so far.  A timer at the window's end clears the bitmap."""

    def __init__(self, size_us: int):
        self.size = size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.words = handle.getMapState("words", "word long", "bits long")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, ["seq"]).drop_duplicates("offset")
        got = self.count.get()
        n = 0 if got is None else got[0]
        out, held = [], {}
        for offset, seq in zip(df["offset"].tolist(), df["seq"].tolist()):
            word, bit = offset >> 6, 1 << (offset & 63)
            if word not in held:
                old = self.words.getValue((word,))
                held[word] = [0 if old is None else old[0] & (1 << 64) - 1, False]
            if not held[word][0] & bit:
                held[word] = [held[word][0] | bit, True]
                n += 1
                out.append((key[0], offset, seq, n))
        for word, (bits, changed) in held.items():
            if changed:
                self.words.updateValue((word,), (bits - (1 << 64) if bits >> 63 else bits,))
        if out:
            self.count.update((n,))
        self.handle.registerTimer(_ms_ceil(key[0] + self.size))
        yield pd.DataFrame(out, columns=COLS_A10)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.words.clear()
        self.count.clear()
        yield pd.DataFrame([], columns=COLS_A10)

    def close(self) -> None:
        pass


def bloom_changelog_stream(df: DataFrame, ts: str, size, value: str, seq: str, *, ets: str = "ets") -> DataFrame:
    """``df`` with a watermark on ``ets``; output as ``operators.aggregate.bloom_changelog``."""
    use_rocksdb(df.sparkSession)
    size_us = duration_seconds(size) * 1_000_000
    start = F.unix_micros(F.window(F.col(ts).cast("timestamp"), f"{duration_seconds(size)} seconds").start)
    x = df.select(start.alias("start_us"), bloom_offset(value).alias("offset"), F.col(seq).alias("seq"), ets)
    out = x.groupBy("start_us").transformWithStateInPandas(
        statefulProcessor=BloomChangelogProcessor(size_us), outputStructType="start_us long, offset long, first_seq long, uv long",
        outputMode="Append", timeMode="EventTime")
    at = lambda us: F.timestamp_micros(us).cast("timestamp_ntz")
    return out.select(at(F.col("start_us")).alias("window_start"), at(F.col("start_us") + size_us).alias("window_end"), "offset", "first_seq", "uv")


# Processors are pickled by value: their code travels with the query, so the
# Python runners (including the driver-side transformWithState runner, which
# unpickles before any shipped py-file is on its path) never import eventide.
def _pickle_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
