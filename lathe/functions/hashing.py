"""Seeded key hashes used for splits and folds.

Hashes are built from the key's string form and the seed only (never from
doubles), so the same row lands in the same split on every engine that has
``md5``: Spark and DuckDB agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: str | Column, seed: int) -> Column:
    """128-bit md5 of ``key#seed`` as 32 lowercase hex digits."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("#", k.cast("string"), F.lit(str(seed))))


def _hex_slice_to_long(h: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(h, start, length), 16, 10).cast("long")


def key_hash_u32(key: str | Column, seed: int) -> Column:
    """Unsigned 32-bit value of the first 8 hex digits of ``key_hash``."""
    return _hex_slice_to_long(key_hash(key, seed), 1, 8)


def hash_fold(key: str | Column, seed: int, k: int) -> Column:
    """Fold id in [0, k) from hex digits 9..16 of the hash.

    Those digits are independent of the ones the hold-out split uses, so fold
    sizes stay balanced inside the training part.
    """
    return F.pmod(_hex_slice_to_long(key_hash(key, seed), 9, 8), F.lit(k)).cast("int")
