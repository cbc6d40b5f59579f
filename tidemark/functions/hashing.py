"""Reproducible pseudo-random order and numbers from md5 of a key; other SQL engines agree on it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_hash(key: Column | str, seed: int = 42) -> Column:
    """32 hex digits that depend on the seed and the key only."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def unit_interval(key: Column | str, seed: int = 42) -> Column:
    """Uniform number in [0, 1) from the first eight hex digits."""
    digits = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10)
    return digits.cast("double") / F.lit(4294967296.0)
