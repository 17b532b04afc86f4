"""Doubles taken apart exactly, as column expressions.

A finite double other than zero is ``sign * mantissa * 2^exponent`` with an
integer mantissa below 2^53.  Powers of two are exact in double arithmetic, so
every step here is exact: the estimate of the exponent by a logarithm, which may
be one off, is put right by comparing with the power itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exponent of the last place of the smallest doubles.
LOWEST = -1074
#: Bits of a lane of the mantissa; three lanes hold 53 bits.
LANE = 18


def is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))


def exponent(v: Column) -> Column:
    """Exponent of the last place of a finite ``v`` other than zero; NULL for others."""
    a = F.abs(v)
    guess = F.floor(F.log2(a)).cast("int")
    power = F.pow(F.lit(2.0), guess)
    exact = guess + F.when(a >= power * 2, 1).otherwise(0) - F.when(a < power, 1).otherwise(0)
    return F.when(is_finite(v) & (v != 0), F.greatest(exact - 52, F.lit(LOWEST))).cast("int")


def mantissa(v: Column, exp: Column) -> Column:
    """``v / 2^exp`` as a signed BIGINT; 0 where there is no exponent."""
    return F.coalesce((v / F.pow(F.lit(2.0), exp)).cast("bigint"), F.lit(0).cast("bigint"))


def lanes(m: Column) -> tuple[Column, Column, Column]:
    """Low, middle and high lane of a signed mantissa, each with its sign."""
    a, mask = F.abs(m), F.lit((1 << LANE) - 1)
    sign = F.signum(m).cast("bigint")
    return (sign * a.bitwiseAND(mask), sign * F.shiftright(a, LANE).bitwiseAND(mask), sign * F.shiftright(a, 2 * LANE))


def ordered_digits(v: Column) -> tuple[Column, Column, Column, Column]:
    """Four integers whose order, one after the other, is the order of finite doubles.

    The first holds sign, exponent and six bits of the fraction, the others 16, 15
    and 15 bits more; equal digits mean equal values (-0.0 and 0.0 among them).
    Infinities lie beyond all others.
    """
    e = exponent(v)
    a = F.abs(mantissa(v, e))
    # numbers below 2^52 are those of the lowest exponent: they come first
    first = (e.cast("bigint") - LOWEST) * 64 + F.shiftright(a, 46) + 1
    sign = F.signum(v).cast("bigint")
    top = F.when(v == 0, F.lit(0).cast("bigint")).when(F.abs(v) == float("inf"), sign * (1 << 40)).otherwise(sign * first)

    def digit(shift, bits):
        return sign * F.when(is_finite(v), F.shiftright(a, shift).bitwiseAND(F.lit((1 << bits) - 1))).otherwise(0)
    return top, digit(30, 16), digit(15, 15), digit(0, 15)
