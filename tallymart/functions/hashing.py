"""Pseudo-random but reproducible choices: they depend on the key and the seed, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: str, seed: int) -> Column:
    """32 hex digits per key; their text order is a random order of the keys."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def share_limit(share: float) -> str:
    """The 8 hex digits below which a ``share`` of all hashes falls."""
    if share >= 1:
        return "g"
    return f"{int(round(share * 16**8)):08x}"


def in_share(hashed: Column, share: float) -> Column:
    return hashed < F.lit(share_limit(share))


def unit_interval(*parts: Column | str) -> Column:
    """A number in [0, 1) derived from the given columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
