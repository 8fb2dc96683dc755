"""Seeded randomness that is the same on every engine and every run.

``rand()`` depends on partitioning; an MD5 of seed and key does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits are 52 bits, which a double holds exactly.
HEX_DIGITS = 13


def seeded_key(seed: int | str, *cols: str | Column) -> Column:
    """Hex key that orders rows in a seeded random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c) if isinstance(c, str) else c for c in cols]))


def hex_prefix(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def uniform(seed: int | str, *cols: str | Column) -> Column:
    """Uniform number in [0, 1)."""
    return hex_prefix(seeded_key(seed, *cols), HEX_DIGITS).cast("double") / F.lit(float(16**HEX_DIGITS))
