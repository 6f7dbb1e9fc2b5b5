"""Record parsers as column expressions.

Parsing stays JVM-side: ``split`` + ``cast`` (ANSI: a bad value fails the job,
like the reference) or ``try_cast`` with a quarantine flag.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_positional(df: DataFrame, fields: Sequence[tuple[str, str]], *, col: str = "value",
                     sep: str = ",", trim: bool = True, on_error: str = "fail",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Positional delimited record -> typed row.

    ``fields`` = ``[(name, spark_type)]`` in position order.  ``trim`` strips
    blanks around every field (S3); ``trim=False`` keeps them (S3b).
    ``on_error='fail'`` raises on an unparsable value or a short record;
    ``'quarantine'`` yields nulls and a boolean ``_corrupt`` column instead.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    parts = F.split(_col(col), re.escape(sep), -1)
    n = len(fields)
    outs, bad = [], []
    for i, (name, typ) in enumerate(fields):
        raw = F.get(parts, i) if on_error == "quarantine" else parts.getItem(i)
        raw = F.trim(raw) if trim else raw
        if typ == "string":
            val = raw
            miss = raw.isNull()
        elif on_error == "fail":
            val = raw.cast(typ)
            miss = F.lit(False)
        else:
            val = raw.try_cast(typ)
            miss = raw.isNull() | (val.isNull() & raw.isNotNull())
        outs.append(val.alias(name))
        bad.append(miss)
    if on_error == "fail":
        short = F.size(parts) < n
        checked = F.when(short, F.raise_error(F.concat(F.lit("short record: "), _col(col))))
        return df.select(*keep, *outs, checked.alias("_chk")).drop("_chk")
    corrupt = F.size(parts) < n
    for b in bad:
        corrupt = corrupt | b
    return df.select(*keep, *outs, corrupt.alias("_corrupt"))


def parse_access_log(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Space separated access-log line; fields 0 ip, 3 ``dd/MM/yyyy:HH:mm:ss``,
    5 method, 6 url (the zone field 4 is ignored; times are read as UTC)."""
    parts = F.split(_col(col), " ", -1)
    return df.select(
        *keep,
        parts.getItem(0).alias("ip"),
        F.to_timestamp(parts.getItem(3), "dd/MM/yyyy:HH:mm:ss").cast("timestamp_ntz").alias("ts"),
        parts.getItem(5).alias("method"),
        parts.getItem(6).alias("url"),
    )
