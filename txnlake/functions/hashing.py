"""Repeatable numbers from keys, the same in any engine with MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: Column, seed: int, hex_digits: int = 8) -> Column:
    """The first hexadecimal digits (at most 15) of the seeded key's digest, as a whole number."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("long")


def in_share(key: Column, share: float, seed: int) -> Column:
    """Whether the key belongs to a repeatable share of all keys; needs no count, order or shuffle."""
    return key_hash(key, seed) < int(share * 16**8)
