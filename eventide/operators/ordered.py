"""Skew-safe ordered primitives over keyed event sequences.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to a
single task; if one user, sensor or word holds a third of all rows, that task
is the whole job.  Every primitive here cuts long keys into *slices*, where the data is:

* ``cuts`` counts the rows of each key (a partial aggregate).  A key of at most
  ``TARGET`` rows is one slice.  The range that the rows of a longer key span is divided into ``BUCKETS``
  equal buckets, the rows of each are counted, and neighbouring buckets are joined until a slice
  holds ``TARGET`` rows, at most twice as many where its last bucket is large.  A slice that still holds more -- a burst -- is divided in the same way again.  What comes
  out are two short tables for each level, of long keys alone; they are written, so that Spark sees their size before it
  chooses how to join them.
* Work inside a slice is a window partitioned by ``(key, slice)``.  What has to cross a slice boundary is
  summarised in a *carry* table with one row per slice of a long key.  Slice numbers are digits of
  ``DIGIT`` bits, one for each level, and the carry is ordered digit by digit: no window over it sees more
  than ``BUCKETS`` + 1 slices, whatever a key holds.

Carry rows are unioned into the data as marker rows that sort first in their
``(key, slice)`` partition, so the big side is shuffled exactly once, and null keys form their own group exactly
as in ``GROUP BY``.  With no long key there is no slice to carry over, and a pass is the plain window.

The slicing column must be a whole number that is monotone in the order (microseconds, a sequence number); rows of one
value of it always share a slice, and nulls lie before all values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.session import materialize

SLICE = "_oslice"
MARK = "_omark"  # 0 = carry marker row, 1 = data row
RN = "_orn"

_AGG = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE_KIND = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
TARGET = 1 << 17  # rows of a slice
BUCKETS = 1 << 10  # buckets of one level
DIGIT = 11  # bits of a slice number that one level takes: BUCKETS and the nulls
MAX_LEVELS = 5


# ------------------------------------------------------------------- slices
def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)], F.lit(True))


def _bucket(value: str) -> Column:
    """0 for null, else 1 to BUCKETS; values beyond the counted range fall to its ends."""
    place = F.least(F.greatest(F.expr(f"({value} - _olo) div _owidth"), F.lit(0)), F.lit(BUCKETS - 1))
    return F.coalesce(place + 1, F.lit(0)).cast("int")


class Cuts:
    """Where the long keys of a table are cut: for each level the divided groups (keys, digits so far, _olo, _owidth) and
    the digit of each of their buckets."""

    def __init__(self, keys: Sequence[str], value: Column, levels: Sequence[tuple[DataFrame, DataFrame]]):
        self.keys, self.value, self.levels = list(keys), value, list(levels)

    @property
    def depth(self) -> int:
        return len(self.levels)

    def at(self, value: Column) -> Cuts:
        """The same cuts for rows whose place is ``value``."""
        return Cuts(self.keys, value, self.levels)

    def stage(self, df: DataFrame) -> DataFrame:
        """``df`` between two passes: written once where keys are cut (each pass then reads it twice), else as it is -- passes
        over whole keys follow each other in one stage."""
        return materialize(df) if self.levels else df

    def slice(self, df: DataFrame) -> DataFrame:
        """``df`` with its slice number and, in ``_osplit``, whether its key is cut at all."""
        if not self.levels:
            return df.withColumn(SLICE, F.lit(0).cast("bigint")).withColumn("_osplit", F.lit(False))
        d = df.withColumn("_oval", self.value.cast("bigint"))
        digits: list[str] = []
        for n, (groups, places) in enumerate(self.levels):
            own = [*self.keys, *digits]
            names = [f"_ok{i}" for i in range(len(own))]
            d = d.join(groups.toDF(*names, "_olo", "_owidth"), _same(own, names), "left").drop(*names)
            if not n:
                d = d.withColumn("_osplit", F.col("_owidth").isNotNull())
            d = d.withColumn("_ob", F.when(F.col("_owidth").isNotNull(), _bucket("_oval")))
            found = places.toDF(*names, "_obucket", "_odig")
            d = d.join(found, _same(own, names) & (F.col("_ob") == F.col("_obucket")), "left").drop(*names, "_obucket", "_ob", "_olo", "_owidth")
            digits.append(f"_od{n}")
            d = d.withColumn(digits[-1], F.coalesce("_odig", F.lit(0).cast("bigint"))).drop("_odig")
        number = reduce(lambda a, b: F.shiftleft(a, DIGIT).bitwiseOR(b), [F.col(x) for x in digits])
        return d.withColumn(SLICE, number).drop(*digits, "_oval")


def cuts(df: DataFrame, keys: Sequence[str], value: Column, target: int | None = None) -> Cuts:
    """Equal-depth slices of about ``target`` rows (``TARGET``) for the keys of ``df`` that hold more."""
    target, own = target or TARGET, list(keys)
    rows = df.select(*keys, value.cast("bigint").alias("_oval"))
    groups = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.min("_oval").alias("_lo"), F.max("_oval").alias("_hi"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    while len(levels) < MAX_LEVELS:
        width = F.expr(f"(_hi - _lo) div {BUCKETS} + 1")
        most = 2 * target if levels else target  # neighbouring buckets are joined up to target and a bucket beyond it
        long = materialize(groups.filter((F.col("_n") > most) & (F.col("_hi") > F.col("_lo"))).select(*own, F.col("_lo").alias("_olo"), width.alias("_owidth")))
        if long.isEmpty():
            break
        names = [f"_ok{i}" for i in range(len(own))]
        part = rows.join(long.toDF(*names, "_olo", "_owidth"), _same(own, names)).withColumn("_ob", _bucket("_oval")).drop(*names)
        counted = materialize(part.groupBy(*own, "_ob").agg(F.count(F.lit(1)).alias("_n"), F.min("_oval").alias("_lo"), F.max("_oval").alias("_hi")))
        every = long.select(*own, F.explode(F.sequence(F.lit(0), F.lit(BUCKETS))).alias("_bucket"))
        named = counted.toDF(*names, "_ob", "_n", "_lo", "_hi")
        filled = every.join(named, _same(own, names) & (F.col("_bucket") == F.col("_ob")), "left")
        by_bucket = Window.partitionBy(*own).orderBy("_bucket")
        before = F.coalesce(F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        run = F.dense_rank().over(Window.partitionBy(*own).orderBy("_run")) - 1
        digit = f"_od{len(levels)}"
        numbered = materialize(filled.withColumn("_run", F.floor(before / F.lit(target))).withColumn(digit, run.cast("bigint"))
                               .select(*own, "_bucket", digit, "_n", "_lo", "_hi"))
        levels.append((long, numbered.select(*own, "_bucket", digit)))
        # the rows of the divided groups, with their digit; the others are settled
        place = numbered.select(*own, "_bucket", digit).toDF(*names, "_bucket", digit)
        rows = part.join(place, _same(own, names) & (F.col("_ob") == F.col("_bucket"))).select(*own, digit, "_oval")
        groups = numbered.groupBy(*own, digit).agg(F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        own = [*own, digit]
    return Cuts(keys, value, levels)


def _as_cuts(df: DataFrame, keys: Sequence[str], slices: Column | Cuts) -> Cuts:
    return slices if isinstance(slices, Cuts) else cuts(df, keys, slices)


# ------------------------------------------------------------------- passes
def _order(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(o).desc() if descending else F.col(o).asc() for o in order]


def _coarser(own: str) -> Column:
    """A slice number without its last digit."""
    return F.shiftright(F.col(own), DIGIT)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: Column | Cuts,
            aggs: Sequence[tuple[str, str, Column]], *, exclusive: bool = False, descending: bool = False) -> DataFrame:
    """Running aggregates per key in ``order`` (ties must be broken by ``order``).

    ``aggs`` = ``[(out_name, kind, value_column)]`` with kind in
    count/sum/min/max (count counts non-null values; min/max accept structs,
    giving min_by/max_by).  The frame is every earlier row of the key plus the
    row itself (``exclusive`` drops the row itself).  ``descending`` scans from
    the end (a "next" lookup).  ``slices``: the slicing column, or the ``Cuts`` that an earlier pass over the same rows used.
    """
    c = _as_cuts(df, keys, slices)
    d = c.slice(df)
    return _running(d, list(keys), order, aggs, exclusive, descending, c.depth, F.col("_osplit")).drop(SLICE, "_osplit")


def _running(d: DataFrame, keys: list[str], order: Sequence[str], aggs: Sequence[tuple[str, str, Column]], exclusive: bool, descending: bool,
             depth: int, split: Column) -> DataFrame:
    """``running`` over rows with slice numbers of ``depth`` digits; only rows of ``split`` keys have something to carry."""
    for name, _, col in aggs:
        d = d.withColumn(f"_v_{name}", col)
    group = keys
    if depth:
        own, group = f"_olvl{depth}", [*keys, SLICE]
        summary = d.filter(split).groupBy(*keys, SLICE).agg(*[_AGG[kind](f"_v_{name}").alias(f"_t_{name}") for name, kind, _ in aggs])
        up = summary.withColumnRenamed(SLICE, own).withColumn(SLICE, _coarser(own))
        carry = _running(up, keys, [own], [(f"_c_{name}", _MERGE_KIND[kind], F.col(f"_t_{name}")) for name, kind, _ in aggs],
                         True, descending, depth - 1, F.lit(True))
        carry = carry.select(*keys, F.col(own).alias(SLICE), F.lit(0).alias(MARK), *[f"_c_{name}" for name, _, _ in aggs])
        d = d.withColumn(MARK, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    else:
        d = d.withColumn(MARK, F.lit(1))
    w = Window.partitionBy(*group).orderBy(F.col(MARK), *_order(order, descending))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = w.rowsBetween(Window.unboundedPreceding, -1) if exclusive else upto
    outs = []
    for name, kind, _ in aggs:
        val = _AGG[kind](f"_v_{name}").over(frame)
        if depth:
            inner, carried = val, F.first(f"_c_{name}", ignorenulls=True).over(upto)
            if kind == "count":
                val = inner + F.coalesce(carried, F.lit(0).cast("bigint"))
            elif kind == "sum":
                val = F.when(inner.isNull() & carried.isNull(), F.lit(None)).otherwise(
                    F.coalesce(inner, F.lit(0)) + F.coalesce(carried, F.lit(0)))
            else:
                val = (F.least if kind == "min" else F.greatest)(inner, carried)
        outs.append(val.alias(name))
    out = d.select("*", *outs)
    out = out.filter(F.col(MARK) == 1) if depth else out
    return out.drop(MARK, *[f"_v_{n}" for n, _, _ in aggs], *[f"_c_{n}" for n, _, _ in aggs])


def lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: Column | Cuts,
        lags: dict[str, tuple[str, int]], *, descending: bool = False) -> DataFrame:
    """Values of earlier rows of the same key: ``lags = {out: (column, offset)}``.

    Inside a slice ``lag`` is a plain window function.  The first ``k`` rows of
    a slice take the missing predecessors from a carry row holding the last
    ``k`` rows before the slice.  The carry is built from the last ``k`` rows
    ("tails") of every slice of a long key -- a ``row_number() <= k`` that Catalyst turns
    into a partial, map-side group limit -- by the same function over the
    tails, one digit up.  ``descending`` gives ``lead``.
    """
    c = _as_cuts(df, keys, slices)
    d = c.slice(df)
    return _lag(d, list(keys), list(order), lags, descending, c.depth, F.col("_osplit")).drop(SLICE, "_osplit")


def _lag(d: DataFrame, keys: list[str], order: list[str], lags: dict[str, tuple[str, int]], descending: bool, depth: int, split: Column) -> DataFrame:
    if not depth:
        w = Window.partitionBy(*keys).orderBy(*_order(order, descending))
        return d.select("*", *[F.lag(col, off).over(w).alias(out) for out, (col, off) in lags.items()])
    k = max(off for _, off in lags.values())
    src = sorted({col for col, _ in lags.values()})
    wd = Window.partitionBy(*keys, SLICE).orderBy(*_order(order, not descending))
    tails = (d.filter(split).select(*keys, SLICE, *dict.fromkeys([*order, *src])).withColumn(RN, F.row_number().over(wd))
             .filter(F.col(RN) <= k))
    # over the tails of all slices of a key, the rows just before the first
    # tail of slice s are the last rows of the slices before s
    before = {f"_cy{depth}_{m}_{col}": (col, m) for col in src for m in range(1, k + 1)}
    own, rn, last = f"_olvl{depth}", f"_orn{depth}", f"_olast{depth}"
    firsts = (tails.withColumn(last, F.max(RN).over(Window.partitionBy(*keys, SLICE))).withColumnsRenamed({SLICE: own, RN: rn})
              .withColumn(SLICE, _coarser(own)))
    seen = _lag(firsts, keys, [own, *order], before, descending, depth - 1, F.lit(True))
    carry = seen.filter(F.col(rn) == F.col(last)).select(*keys, F.col(own).alias(SLICE), F.lit(0).alias(MARK), *before)
    u = d.withColumn(MARK, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, SLICE).orderBy(F.col(MARK), *_order(order, descending))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.row_number().over(w) - 1  # of a cut key, the marker is row 1 of every partition
    pos = pos + F.when(F.min(MARK).over(upto) == 1, 1).otherwise(0)
    outs = []
    for out, (col, off) in lags.items():
        expr = F.when(pos > off, F.lag(col, off).over(w))
        for p in range(1, off + 1):
            expr = expr.when(pos == p, F.first(f"_cy{depth}_{off - p + 1}_{col}", ignorenulls=True).over(upto))
        outs.append(expr.alias(out))
    return u.select("*", *outs).filter(F.col(MARK) == 1).drop(MARK, *before)


def read_ahead(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], ahead_seconds: float, slices: Cuts | None,
               aggs: Sequence[tuple[str, str, Column]], asks: Column, keep: Sequence[str]) -> DataFrame:
    """For each row that ``asks``: ``keep`` of it, and ``aggs`` over the rows of its key with ``time <= its time + ahead``
    (its own included, equal times included).

    A sweep: the row asks by one more row at ``time + ahead``, which sorts after the rows of that
    time, and reads the running aggregates at its own place.  Two rows for one, however far it looks ahead.  Rows without
    a time lie before all others and ask nothing.  ``slices``: cuts of the rows by their microseconds, if an earlier pass has them."""
    ahead = F.lit(int(round(ahead_seconds * 1_000_000)))
    kept = [f"_ask_{c}" for c in keep]
    row = F.struct(F.col("_us").alias("_at"), F.lit(0).alias("_asks"), *[F.lit(None).cast(df.schema[c].dataType).alias(k) for c, k in zip(keep, kept)])
    ask = F.struct((F.col("_us") + ahead).alias("_at"), F.lit(1).alias("_asks"), *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    values = [F.when(F.col("_e._asks") == 0, F.col(f"_in_{name}")).alias(f"_in_{name}") for name, _, _ in aggs]
    d = df.withColumn("_us", epoch_micros(ts))
    for name, _, col in aggs:
        d = d.withColumn(f"_in_{name}", col)
    both = F.when(F.coalesce(asks, F.lit(False)) & F.col("_us").isNotNull(), F.array(row, ask)).otherwise(F.array(row))
    events = (d.select(*keys, *[F.col(o).alias(f"_by_{o}") for o in order], *[f"_in_{name}" for name, _, _ in aggs], F.explode(both).alias("_e"))
              .select(*keys, *[f"_by_{o}" for o in order], *values, "_e.*"))
    c = slices.at(F.col("_at")) if slices else cuts(events, keys, F.col("_at"))
    out = running(events, keys, ["_at", "_asks", *[f"_by_{o}" for o in order]], c,
                  [(name, kind, F.col(f"_in_{name}")) for name, kind, _ in aggs])
    return out.filter("_asks = 1").select(*keys, *[F.col(k).alias(x) for x, k in zip(keep, kept) if x not in keys], *[name for name, _, _ in aggs])


def seq_slice(c, rows_per_slice: int) -> Column:
    """Slicing column for orders given by a dense-ish sequence number."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col / F.lit(int(rows_per_slice))).cast("bigint")
