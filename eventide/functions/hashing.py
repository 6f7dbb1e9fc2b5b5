"""Hash used by the Bloom-bitmap unique-visitor counter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same bit offsets:
# polynomial string hash with seed 61 over the characters of the user id,
# masked to a 2^29-bit bitmap.
BLOOM_SEED = 61
BLOOM_BITS = 29


def bloom_offset(c, seed: int = BLOOM_SEED, bits: int = BLOOM_BITS) -> Column:
    """``h = h*seed + char`` over the string form of ``c``, kept modulo 2^bits.

    Reducing modulo 2^bits at every step equals wrapping at 2^64 and masking at
    the end (2^bits divides 2^64), and it never overflows under ANSI mode.
    """
    col = F.col(c) if isinstance(c, str) else c
    chars = F.split(col.cast("string"), "")
    mod = F.lit(1 << bits).cast("bigint")
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda acc, ch: F.pmod(acc * seed + F.ascii(ch).cast("bigint"), mod))
