"""Repeatable random draws.

A draw depends on a row's key, a purpose (``salt``) and a seed, never on how
rows are laid out in partitions. A task that runs again after an executor loss
therefore draws the same numbers, and a split cannot leak rows between sides.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 42
RANGE = 2**32


def draw_bits(keys: list[str], salt: str, seed: int = SEED, *more: Column) -> Column:
    """A whole number in [0, 2^32): the first 32 bits of a hash of the key."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(salt), *[F.col(k).cast("string") for k in keys], *more)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def draw(keys: list[str], salt: str, seed: int = SEED, *more: Column) -> Column:
    """A number in [0, 1)."""
    return draw_bits(keys, salt, seed, *more) / F.lit(float(RANGE))
