"""Record shapers for external stores (S9-S12) and the keyed upsert.

The client wire code of the stores is not part of this library; what the jobs
compute -- the records they send -- is plain columns, written by any Spark
writer or ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bus_payload(df: DataFrame, id_col: str = "id", value_col: str = "temperature") -> DataFrame:
    """payload = id immediately followed by the reading, no separator."""
    return df.select(F.lit(None).cast("string").alias("key"),
                     F.concat(F.col(id_col), F.col(value_col).cast("string")).alias("value"))


def latest_by_key(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """S10/S11 table state: the last value per key in ``order`` (last writer
    wins).  ``max_by`` is a partial aggregate: a hot key is pre-reduced on every
    mapper before the shuffle."""
    ordering = F.struct(*[F.col(o) for o in order])
    return df.groupBy(*keys).agg(*[F.max_by(F.col(c), ordering).alias(c) for c in value_cols])


def upsert_latest_batch(current: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                        value_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """S10 (stream, per micro-batch): merge a batch into the keyed table --
    UPDATE when the key exists, INSERT otherwise, the later row winning."""
    cols = [*keys, *value_cols, *order]
    merged = batch.select(*cols) if current is None else current.select(*cols).unionByName(batch.select(*cols))
    ordering = F.struct(*[F.col(o) for o in order])
    return merged.groupBy(*keys).agg(
        *[F.max_by(F.col(c), ordering).alias(c) for c in [*value_cols, *order]])


def hash_records(df: DataFrame, table: str = "Sensor_temperature", field_col: str = "id",
                 value_col: str = "temperature") -> DataFrame:
    """``HSET table field value`` records, value as text."""
    return df.select(F.lit(table).alias("hash_table"), F.col(field_col).alias("field"),
                     F.col(value_col).cast("string").alias("value"))


def document_records(df: DataFrame, index: str = "sensor", fields: Sequence[str] = ("id", "ts", "temperature"),
                     names: Sequence[str] | None = None) -> DataFrame:
    """One JSON document per row, every field as a string, no document id."""
    names = list(names or fields)
    body = F.to_json(F.struct(*[F.col(f).cast("string").alias(n) for f, n in zip(fields, names)]))
    return df.select(F.lit(index).alias("index"), body.alias("doc"))
