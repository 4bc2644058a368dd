"""Content hashes that replace seeded random draws.

A split or sample decided by a hash of the row key does not depend on
partitioning, task retries or the order rows arrive in, so a job that loses
an executor and recomputes a partition gets exactly the same rows back, and
DuckDB can compute the same decision with the same text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash32(key: Column | str, salt: str = "") -> Column:
    """First 32 bits of ``md5(salt || key)`` as a non-negative bigint."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(salt), k.cast("string")) if salt else k.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(key: Column | str, salt: str = "") -> Column:
    """A uniform value in [0, 1) derived from the key."""
    return hash32(key, salt).cast("double") / F.lit(TWO_POW_32)


def hash_bucket(key: Column | str, buckets: int = 1000, salt: str = "") -> Column:
    """Bucket number in ``[0, buckets)``."""
    return hash32(key, salt) % F.lit(buckets)
