"""Hashing and HyperLogLog register coordinates (H1).

The value, rendered as a string, is hashed to ``bits(method)`` bits.  With
m = 2^p registers, the low p bits choose the register and the remaining bits
give the rank: number of trailing zeros + 1, or their number + 1 when they are
all zero.  Everything is integer arithmetic on JVM columns (no strings of bits).

``md5`` keeps 32 bits: portable, any SQL engine can compute the same registers,
but it saturates near 2^32 distinct values.  ``xxhash64`` keeps all 64 and is
the one for large tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = {"md5": 32, "xxhash64": 64}


def bits(method: str) -> int:
    if method not in BITS:
        raise ValueError(f"unknown hash method {method!r}")
    return BITS[method]


def hash_of(value: Column, method: str = "md5") -> Column:
    """Hash of ``value`` rendered as a string, in the low ``bits(method)`` bits of a BIGINT."""
    s = value.cast("string")
    if bits(method) == 32:
        return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
    return F.xxhash64(s)


def register_of(h: Column, p: int) -> Column:
    """Register index: the low ``p`` bits of the hash."""
    return h.bitwiseAND(F.lit((1 << p) - 1))


def rank_of(h: Column, p: int, width: int = 32) -> Column:
    """Trailing zeros of the upper ``width`` - p bits, plus one."""
    w = F.shiftrightunsigned(h, p)
    lowest = w.bitwiseAND(-w)
    return F.when(w == 0, F.lit(width - p + 1)) \
        .otherwise(F.bit_count(lowest - 1) + 1).cast("int")


def alpha(m: int) -> float:
    """Bias constant of the raw estimate.

    Fixed values (m = 16, 32, 64) and the asymptotic rule for m >= 128 are
    those of Flajolet et al. (2007); m = 32 and m = 64 are the two the
    original job supports.
    """
    fixed = {16: 0.673, 32: 0.697, 64: 0.709}
    if m in fixed:
        return fixed[m]
    return 0.7213 / (1 + 1.079 / m)
