"""Two-stream reconciliation (J1) and order outcome classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.operators import ordered

# Fixed values (must equal the reference's outcome tags): order outcomes are
# "paid", "paid-but-timeout", "time-out" and "data-not-found"; a reconciled
# pair is a "match", what finds no partner is "single-order" or "single-receipt".
PAID, PAID_LATE, TIME_OUT, NOT_FOUND, MATCH = "paid", "paid-but-timeout", "time-out", "data-not-found", "match"
SINGLE_ORDER, SINGLE_RECEIPT = "single-order", "single-receipt"


def interval_reconcile(left: DataFrame, right: DataFrame, key: str, *, bound_seconds: float,
                       left_cols: Sequence[str], right_cols: Sequence[str], lts: str, rts: str, lseq: str, rseq: str,
                       tags: tuple[str, str, str] = (MATCH, SINGLE_ORDER, SINGLE_RECEIPT)) -> DataFrame:
    """One-to-one pairing of two streams per ``key``, as with one waiting slot.

    The rows of a key are taken in event time (left before right, then by
    ``lseq`` / ``rseq``, where times are equal).  A row pairs with the row just
    before it if that is of the other side, at most ``bound`` older and not
    paired yet; otherwise it waits in its turn.  So of a chain of rows that
    each could pair with the one before, the first and second pair, the third
    and fourth, and so on -- every row is in one output row, which makes at
    most left + right rows, whatever one key holds.

    One union, cut into slices of the key's time like every ordered primitive:
    a hot key is never in one task.  The passes that find the pairs see key, time, side and sequence number; a row's
    ``left_cols`` / ``right_cols`` ride along as one struct, and only the last pass looks back for the partner's.
    """
    def side(d: DataFrame, no: int, ts: str, seq: str) -> DataFrame:
        own = lambda cols, schema, mine: F.struct(*[(F.col(c) if mine else F.lit(None).cast(schema[c].dataType)).alias(c) for c in cols])
        return d.select(key, F.col(ts).alias("_ts"), F.lit(no).alias("_side"), F.col(seq).alias("_seq"), F.struct(
            own(left_cols, left.schema, no == 0).alias("l"), own(right_cols, right.schema, no == 1).alias("r")).alias("_own"))

    rows = side(left, 0, lts, lseq).unionByName(side(right, 1, rts, rseq))
    order, width = ["_ts", "_side", "_seq"], F.lit(int(round(bound_seconds * 1_000_000)))
    within = F.coalesce(epoch_micros("_ts") - epoch_micros("_pts") <= width, F.lit(False))
    cuts = ordered.cuts(rows, [key], epoch_micros("_ts"))
    d = ordered.lag(rows, [key], order, cuts, {"_pside": ("_side", 1), "_pts": ("_ts", 1)})
    d = cuts.stage(d.withColumn("_link", F.coalesce(F.col("_pside") != F.col("_side"), F.lit(False)) & within).drop("_pside", "_pts"))
    d = cuts.stage(ordered.running(d, [key], order, cuts, [("_n", "count", F.lit(1))]))
    d = ordered.running(d, [key], order, cuts, [("_head", "max", F.when(~F.col("_link"), F.col("_n")))])
    d = cuts.stage(d.withColumn("_second", (F.col("_n") - F.col("_head")) % 2 == 1).drop("_n", "_head", "_link"))
    d = cuts.stage(ordered.lag(d, [key], order, cuts, {"_paired": ("_second", 1)}, descending=True))
    d = ordered.lag(d, [key], order, cuts, {"_partner": ("_own", 1)})
    mine = F.col("_second")
    pick = lambda part, c: F.coalesce(F.col(f"_own.{part}.{c}"), F.when(mine, F.col(f"_partner.{part}.{c}"))).alias(c)
    outcome = F.when(mine, F.lit(tags[0])).when(F.col("_side") == 0, F.lit(tags[1])).otherwise(F.lit(tags[2]))
    return d.filter(mine | ~F.coalesce("_paired", F.lit(False))).select(
        key, *[pick("l", c) for c in left_cols], *[pick("r", c) for c in right_cols], outcome.alias("outcome"))


def order_outcomes(df: DataFrame, keys: Sequence[str], ts: str, seq: str, is_create: Column, is_pay: Column,
                   *, limit_seconds: float) -> DataFrame:
    """Per order, first create and first pay (event time, then arrival),
    classified as ``paid`` (pay < create + limit, or pay before create),
    ``paid-but-timeout``, ``time-out`` (create only) or ``data-not-found`` (pay
    only).  One partial aggregate per order key; no join."""
    first = lambda cond: F.min(F.when(cond, F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))))
    g = df.groupBy(*keys).agg(first(is_create).alias("_c"), first(is_pay).alias("_p"))
    g = g.filter(F.col("_c").isNotNull() | F.col("_p").isNotNull())
    c, p = F.col("_c.t"), F.col("_p.t")
    limit = F.expr(f"INTERVAL {int(round(limit_seconds * 1_000_000))} MICROSECONDS")
    outcome = (F.when(F.col("_c").isNull(), F.lit(NOT_FOUND))
               .when(F.col("_p").isNull(), F.lit(TIME_OUT))
               .when(p < c + limit, F.lit(PAID))
               .otherwise(F.lit(PAID_LATE)))
    return g.select(*keys, outcome.alias("outcome"), c.alias("create_ts"), p.alias("pay_ts"))
