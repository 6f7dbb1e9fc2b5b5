"""Column-expression helpers (JVM-side, codegen friendly)."""

from eventide.functions.hashing import bloom_offset
from eventide.functions.text import jvm_split
from eventide.functions.time import (
    epoch_micros, epoch_seconds, event_time, local_day, seconds_to_ts, time_slice,
)

__all__ = ["bloom_offset", "jvm_split", "epoch_micros", "epoch_seconds", "event_time",
           "local_day", "seconds_to_ts", "time_slice"]
