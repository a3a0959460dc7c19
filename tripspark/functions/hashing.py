"""Partition-independent pseudo-random keys from row keys.

``rand(seed)`` depends on the partitioning of its input, so reruns on a
different cluster pick different rows; hashing a stable key does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _digest(key: Column, seed: int | None) -> Column:
    text = key.cast("string")
    if seed is not None:
        text = F.concat(F.lit(f"{seed}:"), text)
    return F.md5(text)


def hash_percent(key: Column, seed: int | None = None) -> Column:
    """0..99 from the first 24 bits of md5(key)."""
    return (F.conv(F.substring(_digest(key, seed), 1, 6), 16, 10).cast("bigint") % 100).cast("int")


def hash_order_key(key: Column, seed: int | None = None) -> Column:
    """A sort key that orders rows pseudo-randomly but reproducibly."""
    return _digest(key, seed)
