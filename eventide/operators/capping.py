"""Capped click filtering and black-listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import local_day

# Fixed values (must equal the reference's output): the black-list message is
# "black user: <cap> times today"; the day boundary is local midnight at UTC+8.
BLACK_LIST_PREFIX = "black user: "
BLACK_LIST_SUFFIX = " times today"
DAY_OFFSET_HOURS = 8


def first_clicks(df: DataFrame, keys: Sequence[str], ts: str, seq: str, limit: int, *,
                 day_offset_hours: int = DAY_OFFSET_HOURS) -> DataFrame:
    """The first ``limit`` clicks of every (keys, local day) group, in event time
    then arrival order, with ``day`` and their number ``click_no``.

    ``row_number() <= limit`` is a group limit that Spark applies before the
    shuffle too, so a task sends at most ``limit`` rows of a group, however
    many clicks the group holds."""
    d = df.withColumn("day", local_day(ts, day_offset_hours))
    w = Window.partitionBy(*keys, "day").orderBy(ts, seq)
    d = d.withColumn("click_no", F.row_number().over(w)).filter(F.col("click_no") <= limit)
    return d.withColumn("click_no", F.col("click_no").cast("bigint"))


def cap_clicks(df: DataFrame, keys: Sequence[str], ts: str, seq: str, cap: int) -> DataFrame:
    """B1: pass at most ``cap`` clicks per (keys, day); the rest are dropped."""
    return first_clicks(df, keys, ts, seq, cap)


def black_list(df: DataFrame, keys: Sequence[str], ts: str, seq: str, cap: int) -> DataFrame:
    """B2: one black-list row per (keys, day), on click ``cap + 1``."""
    return (first_clicks(df, keys, ts, seq, cap + 1).filter(F.col("click_no") == cap + 1)
            .select(*keys, "day", F.concat(F.lit(BLACK_LIST_PREFIX), F.lit(str(cap)),
                                           F.lit(BLACK_LIST_SUFFIX)).alias("warning")))
