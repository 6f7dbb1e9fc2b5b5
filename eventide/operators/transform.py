"""Projection, filters, routing and multi-stream shaping (P, F, R, M)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's output): split tags, the co-map
# messages, and the constant key of the unique-visitor mapping.
HIGH, LOW = "high", "low"
HIGH_MESSAGE, LOW_MESSAGE = "high temp warning", "low temp"
DUMMY_KEY = "dummyKey"


def constant_key(df: DataFrame, value_col: str, key: str = DUMMY_KEY, name: str = "key") -> DataFrame:
    """Map every row to (constant key, value)."""
    return df.select(F.lit(key).alias(name), F.col(value_col))


def pair_with_literal(df: DataFrame, col: str, literal: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Each row becomes two rows -- its ``col`` then the literal -- in order."""
    return df.select(*keep, F.posexplode(F.array(F.col(col).cast("string"), F.lit(literal))).alias("pos", "out"))


def equal_filter(df: DataFrame, col: str, value) -> DataFrame:
    """F1"""
    return df.filter(F.col(col) == F.lit(value))


def not_equal_filter(df: DataFrame, col: str, value) -> DataFrame:
    """F2"""
    return df.filter(F.col(col) != F.lit(value))


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """string prefix; ``'sensor_1'`` also matches ``'sensor_10'``."""
    return df.filter(F.col(col).startswith(prefix))


def non_empty_filter(df: DataFrame, col: str) -> DataFrame:
    """non-null and non-empty."""
    return df.filter(F.col(col).isNotNull() & (F.length(F.col(col)) > 0))


def expr_select_filter(df: DataFrame, select: Sequence[str], where: str) -> DataFrame:
    """string expressions, as on a relational table."""
    return df.selectExpr(*select).filter(where)


def tag_threshold(df: DataFrame, col: str, threshold: float = 30.0, name: str = "tag") -> DataFrame:
    """``high`` when strictly above the threshold, else ``low``."""
    return df.withColumn(name, F.when(F.col(col) > threshold, F.lit(HIGH)).otherwise(F.lit(LOW)))


def select_tags(tagged: DataFrame, tags: Sequence[str], name: str = "tag") -> DataFrame:
    """R1 select: the rows carrying any of ``tags``."""
    return tagged.filter(F.col(name).isin(list(tags)))


def route_side_output(df: DataFrame, id_col: str, col: str, threshold: float = 30.0) -> DataFrame:
    """R2: rows at or above the threshold go to the ``side`` channel as a
    warning message; the others stay on ``main`` unchanged."""
    side = F.col(col) >= threshold
    msg = F.concat(F.lit("warning: "), F.col(id_col), F.lit(" temperature "),
                   F.col(col).cast("string"), F.lit(" too high"))
    return df.withColumn("channel", F.when(side, F.lit("side")).otherwise(F.lit("main"))) \
             .withColumn("message", F.when(side, msg))


def union_all(*dfs: DataFrame) -> DataFrame:
    """M1: bag union of same-typed streams."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def co_map(high: DataFrame, low: DataFrame, id_col: str, col: str) -> DataFrame:
    """M2: connect two differently typed streams and map each with its own
    function into one mixed output."""
    a = high.select(F.col(id_col).alias("id"), F.col(col).alias("temperature"),
                    F.lit(HIGH_MESSAGE).alias("message"))
    b = low.select(F.col(id_col).alias("id"), F.lit(LOW_MESSAGE).alias("message"))
    return a.unionByName(b, allowMissingColumns=True)


def rich_flat_map(df: DataFrame, fn, schema: str, *, open_fn=None, close_fn=None) -> DataFrame:
    """P4 lifecycle / UDF surface: a flat-map over Arrow batches with a
    per-partition ``open`` (its result is passed to every call) and ``close``.
    ``fn(batch: pandas.DataFrame, ctx) -> pandas.DataFrame`` must be vectorised;
    batches stream through the task, nothing is collected per key."""

    def run(batches):
        ctx = open_fn() if open_fn else None
        try:
            for b in batches:
                yield fn(b, ctx)
        finally:
            if close_fn:
                close_fn(ctx)

    return df.mapInPandas(run, schema)


def pair_rows_batch(batch, ctx):
    """P4 as a vectorised batch function: every row -> (its id, then the literal)."""
    import pandas as pd

    literal = (ctx or {}).get("literal", "value")
    first = pd.DataFrame({"seq": batch["seq"], "pos": 0, "out": batch["id"].astype(str)})
    second = pd.DataFrame({"seq": batch["seq"], "pos": 1, "out": literal})
    return pd.concat([first, second], ignore_index=True).astype({"pos": "int32"})


def _pickle_by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
