"""eventide: behaviour- and event-stream analytics as plain Spark DataFrame operators.

Every operator is a function ``op(df, *, params) -> DataFrame`` built from
Catalyst-visible expressions, so predicate pushdown, column pruning, partial
aggregation and AQE apply unchanged.  Streaming forms live in
``eventide.streaming``; the catalogue of registered queries over the driver
tables lives in ``eventide.plans``.
"""

from eventide.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
