"""Sums and differences of 64-bit integers that wrap around, in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW = 0xFFFFFFFF


def low_half(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_LOW))


def high_half(x: Column) -> Column:
    return F.shiftrightunsigned(x, 32)


def joined_halves(high: Column, low: Column) -> Column:
    """The 64-bit number of two halves, which may be sums that exceed 32 bits."""
    return F.shiftleft(high + F.shiftrightunsigned(low, 32), 32).bitwiseOR(low_half(low))


def wrapping_add(a: Column, b: Column, carry: int = 0) -> Column:
    """``a + b`` modulo 2**64."""
    return joined_halves(high_half(a) + high_half(b), low_half(a) + low_half(b) + carry)


def wrapping_subtract(a: Column, b: Column) -> Column:
    """``a - b`` modulo 2**64."""
    return wrapping_add(a, F.bitwise_not(b), 1)
