"""Reproducible randomness: numbers that depend on a seed and a key only.

``rand(seed)`` changes with the partitioning; these do not.
"""

from pyspark.sql import Column, functions as F

HASH_BITS = 52


def hash52(seed: int, key: Column) -> Column:
    """A uniform BIGINT in [0, 2^52): the first 13 hex digits of ``md5("seed:key")``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def unit_interval(hashed: Column) -> Column:
    """Map a 52-bit hash to the open interval (0, 1)."""
    return (hashed + F.lit(0.5)) / F.lit(2.0**HASH_BITS)


def hash_uniform(seed: int, key: Column) -> Column:
    return unit_interval(hash52(seed, key))
