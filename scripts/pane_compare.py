"""Pane pre-aggregation vs naive sliding windows on the events table.
    python scripts/pane_compare.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.operators.windows import window_aggregate  # noqa: E402
from eventide.plans import domain as dm  # noqa: E402
from eventide.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    e = dm.events(spark, sf)
    e.write.format("noop").mode("overwrite").save()
    for size, slide in [("1 hour", "5 minutes"), ("1 hour", "1 minute"), ("1 day", "10 minutes")]:
        for panes in (False, True, False, True):  # second pair = warm
            t = time.perf_counter()
            n = window_aggregate(e, [], "ts", size, slide, panes=panes).count()
            print(size, slide, "panes" if panes else "naive", n, round(time.perf_counter() - t, 2), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
