"""Stable pseudo-random selection by a hash of the row's key."""

from pyspark.sql import Column, functions as F

_DIGITS = 8


def hash_below(key: str | Column, fraction: float, seed: int | str = "") -> Column:
    """True for about ``fraction`` of the keys.

    The choice depends only on the key and the seed, so it survives repartitioning,
    retries and another engine: the first eight hex digits of the md5 of the seed and
    the key, compared as text with the fraction written in the same digits.
    """
    if fraction >= 1:
        return F.lit(True)
    if fraction <= 0:
        return F.lit(False)
    key = F.col(key) if isinstance(key, str) else key
    salted = F.concat(F.lit(str(seed)), key.cast("string"))
    return F.substring(F.md5(salted.cast("binary")), 1, _DIGITS) < F.lit(hex_bound(fraction))


def hex_bound(fraction: float) -> str:
    """The fraction of the unit interval as eight hex digits."""
    return format(int(fraction * 16**_DIGITS), f"0{_DIGITS}x")
