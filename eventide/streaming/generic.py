"""Generic per-key stream processors, vectorised over each micro-batch.

``running_stream`` carries running aggregates per key and ``lag_stream`` the
last ``k`` rows per key, each as one small value-state document; inside a
batch both are pandas column operations (cumsum / cummin / shift), never a
Python loop per row.  Rows are sorted by the order columns inside the handler,
so the output does not depend on how the stream was cut into batches -- as long
as a key's rows arrive in order across batches (the replay guarantees it).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from eventide.streaming.replay import use_rocksdb


def _frame(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    frames = list(rows)
    df = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()
    return df.sort_values(list(order), kind="stable").reset_index(drop=True) if len(df) else df


PARTS = 512  # hash parts that the keys of a stream are dealt into
PART = "hash_part"  # rows reach Python as named tuples, whose names may not begin with _


def in_parts(df: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """``df`` with the hash part of its keys.  A handler is called once for each part of a micro-batch, not for each key: what a call
    costs (a state request, a data frame, a timer) is then paid ``parts`` times, however many keys there are.  Keys
    go as text, which pandas leaves alone where a long beside a null would become a float."""
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias(PART)
    return df.select(part, *[F.col(c).cast("string").alias(c) if c in keys else F.col(c) for c in df.columns])


def records(df: pd.DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The rows as tuples of plain Python values."""
    return list(zip(*[df[c].tolist() for c in columns]))


class TimeBuckets:
    """Rows waiting for the watermark, in map state by time bucket: a row is added to its bucket alone, and the timer at a
    bucket's end reads that bucket alone, however many rows wait behind it.

    A timer at the end of a bucket means that the watermark has passed every row of it; timers of a key come in
    order, so buckets are taken in order, too."""

    def __init__(self, handle: StatefulProcessorHandle, width_us: int):
        self.handle, self.width = handle, width_us
        self.rows = handle.getMapState("held", "bucket long", "rows string")

    def end_after(self, ts_us: int) -> int:
        """The end of the bucket of ``ts_us``, in milliseconds."""
        return (ts_us // self.width + 1) * self.width // 1000

    def add(self, df: pd.DataFrame, ts_us: str) -> None:
        for b, part in df.groupby(df[ts_us] // self.width):
            text = json.dumps(records(part, part.columns))
            held = self.rows.getValue((int(b),))
            self.rows.updateValue((int(b),), (text if held is None else held[0] + "\n" + text,))
            self.handle.registerTimer((int(b) + 1) * self.width // 1000)

    def take_due(self, watermark_ms: int) -> tuple[list[list], int]:
        """(rows of every bucket that the watermark has passed, the time up to which that is all rows): the keys of the waiting
        buckets are listed, only due ones are read."""
        end = watermark_ms * 1000 // self.width
        rows = []
        for (b,) in sorted(k for k in self.rows.keys() if k[0] < end):
            rows += self.take((b + 1) * self.width // 1000)
        return rows, end * self.width

    def take(self, end_ms: int) -> list[list]:
        """The rows of the bucket that ends at ``end_ms``; it is empty afterwards."""
        b = (end_ms * 1000 // self.width - 1,)
        held = self.rows.getValue(b)
        if held is None:
            return []
        self.rows.removeKey(b)
        return [r for line in held[0].split("\n") for r in json.loads(line)]


class InOrder(StatefulProcessor):
    """Holds a key's rows until the watermark has passed their time bucket, then hands them to ``inner`` in event time: ``inner``
    sees each key in order across micro-batches, however disordered the rows arrived within the watermark's delay (L2).  Rows
    later than that are dropped by Spark.  Columns are longs, doubles, strings or booleans."""

    def __init__(self, inner: StatefulProcessor, columns: Sequence[str], ts_us: str, width_us: int):
        self.inner, self.columns, self.ts_us, self.width = inner, list(columns), ts_us, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inner.init(handle)
        self.held = TimeBuckets(handle, self.width)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for df in rows:
            self.held.add(df[self.columns], self.ts_us)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ready, _ = self.held.take_due(timerValues.getCurrentWatermarkInMs())  # the first timer of a batch takes every due bucket
        if ready:
            yield from self.inner.handleInputRows(key, iter([pd.DataFrame(ready, columns=self.columns)]), timerValues)

    def close(self) -> None:
        self.inner.close()


BUCKET_SECONDS = 86_400  # of event time that one entry of held rows spans


def _transform(df: DataFrame, keys: Sequence[str], proc: StatefulProcessor, out_schema, in_order: str | None, ets: str) -> DataFrame:
    """``proc`` per key in append mode; ``in_order`` names a microsecond column whose order is kept by waiting for the
    watermark on ``ets`` (else rows are taken as their micro-batches bring them)."""
    use_rocksdb(df.sparkSession)
    if in_order:
        proc = InOrder(proc, [c for c in df.columns if c != ets], in_order, BUCKET_SECONDS * 1_000_000)
    return df.groupBy(*keys).transformWithStateInPandas(statefulProcessor=proc, outputStructType=out_schema, outputMode="Append",
                                                        timeMode="EventTime" if in_order else "None")


class RunningProcessor(StatefulProcessor):
    """Running count / sum / min / max / min_by per key.

    ``specs`` = ``[(out, kind, column[, payload columns])]``; state is one JSON
    document per key holding the carried aggregate of every spec.
    """

    def __init__(self, order: Sequence[str], specs: Sequence[tuple], out_cols: Sequence[str]):
        self.order, self.specs, self.out_cols = list(order), list(specs), list(out_cols)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("carry", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        got = self.state.get()
        carry = json.loads(got[0]) if got is not None else {}
        new = {}
        for spec in self.specs:
            out, kind, col = spec[0], spec[1], spec[2]
            v = df[col]
            if kind == "count":
                c = v.notna().astype("int64").cumsum() + int(carry.get(out, 0))
                df[out], new[out] = c, int(c.iloc[-1])
            elif kind == "sum":
                v = v if v.dtype.kind in "iu" else v.astype("Int64") if _whole(v) else v.astype("float64")
                c = v.fillna(0).cumsum() + carry.get(out, 0)
                df[out], new[out] = c, _py(c.iloc[-1])
            elif kind in ("min", "max"):
                prev = carry.get(out)  # whole numbers stay whole: a long beyond 2**53 would not survive a float
                kind_ = "Int64" if _whole(v) and (prev is None or isinstance(prev, int)) else "float64"
                series = pd.concat([pd.Series([pd.NA if kind_ == "Int64" and prev is None else np.nan if prev is None else prev], dtype=kind_),
                                    v.astype(kind_)], ignore_index=True)
                acc = (series.cummin() if kind == "min" else series.cummax()).ffill()
                df[out] = acc.iloc[1:].to_numpy(dtype=object, na_value=None)
                last = acc.iloc[-1]
                new[out] = None if pd.isna(last) else _py(last)
            elif kind == "min_by":  # whole row of the smallest value; the earliest wins ties
                payload = spec[3]
                prev = carry.get(out)  # [value, payload...]
                vals = v.to_numpy(dtype="float64")
                filled = np.where(np.isnan(vals), np.inf, vals)
                start = np.inf if prev is None else prev[0]
                before = np.minimum.accumulate(np.concatenate([[start], filled]))[:-1]
                # index of the row holding the running minimum (-1: the carried row)
                idx = np.maximum.accumulate(np.where(filled < before, np.arange(len(vals)), -1))
                for j, pc in enumerate([col, *payload]):
                    src = df[pc].to_numpy(dtype=object)
                    carried = None if prev is None else prev[j]
                    df[f"{out}_{pc}"] = np.concatenate([np.array([carried], dtype=object), src])[idx + 1]
                k_last = idx[-1]
                new[out] = prev if k_last < 0 else [_py(df[pc].iloc[k_last]) for pc in [col, *payload]]
        self.state.update((json.dumps(new),))
        yield df[self.out_cols]

    def close(self) -> None:
        pass


def _whole(v: pd.Series) -> bool:
    return v.dtype.kind in "iu" or str(v.dtype) in ("Int64", "Int32")


def _py(x):
    return x.item() if hasattr(x, "item") else x


def _plain(v) -> list:
    """The values of an array as JSON takes them."""
    return v.to_numpy(dtype=object, na_value=None).tolist() if isinstance(v, pd.api.extensions.ExtensionArray) else v.tolist()


def running_stream(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Sequence[tuple],
                   out_schema: StructType, *, in_order: str | None = None, ets: str = "ets") -> DataFrame:
    return _transform(df, keys, RunningProcessor(order, specs, [f.name for f in out_schema.fields]), out_schema, in_order, ets)


_NULLABLE = {"bigint": "Int64", "int": "Int32", "boolean": "boolean"}


class LagProcessor(StatefulProcessor):
    """Values of the previous ``k`` rows of the key (``lags`` = {out: (col, j)}), for all keys of a part at once: rows of a key
    are put together, its last rows from before in front, and a lag is a look ``j`` places back.  State: the last
    ``k`` rows of every key of the part.  ``keep``: the kept columns and their Spark types."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], lags: dict, keep: dict[str, str], out_cols: Sequence[str]):
        self.keys, self.order, self.lags, self.out_cols = list(keys), list(order), dict(lags), list(out_cols)
        self.keep = {c: _NULLABLE.get(kind) for c, kind in keep.items()}
        self.k = max(j for _, j in lags.values())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getValueState("tail", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        got = self.tail.get()
        before = json.loads(got[0]) if got is not None else [[] for _ in (*self.keys, *self.keep)]
        n = len(before[0])
        both = {c: held + df[c].tolist() for c, held in zip((*self.keys, *self.keep), before)}
        both = {c: pd.array(v, dtype=self.keep[c]) if self.keep.get(c) else np.array(v, dtype=object) for c, v in both.items()}
        group = pd.DataFrame({c: both[c] for c in self.keys}).groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        at = np.argsort(group, kind="stable")
        group = group[at]
        for out, (c, j) in self.lags.items():
            source = np.full(len(at), -1)
            source[at[j:]] = np.where(group[j:] == group[:-j], at[:-j], -1)
            df[out] = pd.api.extensions.take(both[c], source[n:], allow_fill=True)
        last = at[np.searchsorted(group, group, "right") - np.arange(len(at)) <= self.k]
        self.tail.update((json.dumps([_plain(v[last]) for v in both.values()]),))
        yield df[self.out_cols]

    def close(self) -> None:
        pass


def lag_stream(df: DataFrame, keys: Sequence[str], order: Sequence[str], lags: dict,
               lag_types: dict, *, in_order: str | None = None, ets: str = "ets") -> DataFrame:
    """Adds ``lags`` columns (types in ``lag_types``) to every row of ``df`` (without ``ets``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    keep = {c: types[c].simpleString() for c in dict.fromkeys([*order, *[c for c, _ in lags.values()]]) if c not in keys}
    dealt = in_parts(df, keys)
    schema = StructType([f for f in dealt.schema.fields if f.name not in (ets, PART)] + [StructField(o, lag_types[o], True) for o in lags])
    out = _transform(dealt, [PART], LagProcessor(keys, order, lags, keep, [f.name for f in schema.fields]), schema, in_order, ets)
    return out.select(*[F.col(c).cast(types[c]).alias(c) if c in keys else F.col(c) for c in out.columns])


class CountWindowProcessor(StatefulProcessor):
    """Count windows per key.  State keeps the key's row count and its
    last ``size - 1`` values; a window fires at every ``slide``-th row over the
    last ``<= size`` values (tumbling: ``slide = size``, full windows only)."""

    def __init__(self, order: Sequence[str], value: str, size: int, slide: int, full_only: bool):
        self.order, self.value, self.size, self.slide, self.full_only = list(order), value, size, slide, full_only

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("tail", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _frame(rows, self.order)
        got = self.state.get()
        n0, tail = json.loads(got[0]) if got is not None else (0, [])
        vals = pd.Series(tail + df[self.value].astype("float64").tolist())
        pos = np.arange(n0 - len(tail) + 1, n0 + len(df) + 1)  # 1-based positions of vals
        roll = vals.rolling(self.size, min_periods=1)
        # a window counts rows; a null value is a row too
        res = pd.DataFrame({"end_pos": pos, "cnt": np.minimum(pos, self.size), "max_value": roll.max(),
                            "min_value": roll.min()})
        fire = (res["end_pos"] > n0) & (res["end_pos"] % self.slide == 0)
        if self.full_only:
            fire &= res["cnt"] == self.size
        out = res[fire].copy()
        out.insert(0, "key", key[0])
        n1 = n0 + len(df)
        self.state.update((json.dumps([n1, vals.iloc[-(self.size - 1):].tolist() if self.size > 1 else []]),))
        yield out

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, key: str, order: Sequence[str], value: str, size: int,
                        slide: int | None = None, *, in_order: str | None = None, ets: str = "ets") -> DataFrame:
    """Output: ``key, end_pos, cnt, max_value, min_value`` per fired window."""
    proc = CountWindowProcessor(order, value, size, slide or size, full_only=slide is None)
    key_type = df.schema[key].dataType.simpleString()
    schema = f"key {key_type}, end_pos long, cnt long, max_value double, min_value double"
    return _transform(df, [key], proc, schema, in_order, ets).withColumnRenamed("key", key)


# Processors are pickled by value: their code travels with the query, so the
# Python runners (including the driver-side transformWithState runner, which
# unpickles before any shipped py-file is on its path) never import eventide.
def _pickle_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
