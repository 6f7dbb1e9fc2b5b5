"""String helpers with the exact semantics the behaviour jobs rely on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_split(c, sep: str = " ") -> Column:
    """Split like ``String.split(sep)`` on the JVM: trailing empty tokens are
    dropped, a non-empty string made only of separators gives no token, and the
    empty string gives one empty token.  Spark's ``split`` keeps trailing
    empties, so strip trailing separators first."""
    c = _col(c)
    q = re.escape(sep)
    # rtrim removes trailing blanks only, without a regex per row
    stripped = F.rtrim(c) if sep == " " else F.regexp_replace(c, f"({q})+$", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q)))


def split_lines(c) -> Column:
    """Lines of a text block (``\\n`` separated, every line kept)."""
    return F.split(_col(c), "\n")
