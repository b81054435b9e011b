"""Repeatable random draws: a hash of row key, seed and stream number.

No generator state exists, so a lost task recomputes the same rows and the
result does not depend on partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Draw = Callable[[int], Column]

_FRACTION_BITS = 53


def fast_uniform(key: Column, seed: int) -> Draw:
    """Uniform draws in [0, 1) from the JVM's 64-bit hash."""

    def draw(stream: int) -> Column:
        bits = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(stream)), F.lit(1 << _FRACTION_BITS))
        return bits / F.lit(float(1 << _FRACTION_BITS))

    return draw


def portable_uniform(key: Column, seed: int) -> Draw:
    """Uniform draws in [0, 1) that other SQL engines can repeat.

    One MD5 digest serves four streams, eight hexadecimal digits each.
    """

    def draw(stream: int) -> Column:
        block, part = divmod(stream, 4)
        digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(str(block))))
        word = F.conv(F.substring(digest, part * 8 + 1, 8), 16, 10).cast("bigint")
        return word / F.lit(float(1 << 32))

    return draw


def below(uniform: Column, size: int) -> Column:
    """Integer 0 .. size - 1."""
    return F.floor(uniform * size)


def within(uniform: Column, first: int, last: int) -> Column:
    """Integer first .. last, both included."""
    return below(uniform, last - first + 1) + first


def normal(u: Column, v: Column, mean: float, spread: float) -> Column:
    """Normal draw from two uniform ones (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u))
    return F.lit(mean) + F.lit(spread) * radius * F.cos(F.lit(2 * math.pi) * v)
