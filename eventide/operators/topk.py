"""Ranking and top-N (K1-K4).

``row_number() <= n`` directly over a window is rewritten by Catalyst into a
partial ``WindowGroupLimit`` before the shuffle, so even a hot group ships at
most ``n`` rows per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """K1/K3: the first ``n`` rows of every group in ``order`` (give a full
    tie-break so results are deterministic)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def ranking_report(ranked: DataFrame, group: str, rank_col: str, line: Column,
                   header: Column) -> DataFrame:
    """K4: one text block per group -- a header line then one line per rank.
    Input is already limited to top-N, so every collected list is bounded."""
    lines = ranked.select(group, F.struct(F.col(rank_col).alias("r"), line.alias("l")).alias("x"),
                          header.alias("_h"))
    g = lines.groupBy(group).agg(F.sort_array(F.collect_list("x")).alias("xs"), F.first("_h").alias("_h"))
    body = F.concat_ws("\n", F.transform("xs", lambda x: x["l"]))
    return g.select(group, F.concat(F.col("_h"), F.lit("\n"), body).alias("report"))
