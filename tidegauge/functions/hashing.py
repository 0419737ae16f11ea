"""Hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hashed visitor bitmap.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def bit_offset(value: Column | str, bits: int = BITMAP_BITS, seed: int = HASH_SEED) -> Column:
    """Polynomial hash of the value's text, masked to a bitmap of ``bits`` (a power of two).

    Masking at every step gives the same low bits as masking once at the end and never overflows.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("long"),
        lambda acc, char: (acc * F.lit(seed) + F.ascii(char)).bitwiseAND(F.lit(bits - 1)),
    )


def shard_of(key: Column | str, shards: int) -> Column:
    """Shard number of a key, independent of where Spark places the row and of the engine."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(shards))
