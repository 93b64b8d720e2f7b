"""Reproducible randomness: every random choice is a hash of ``seed:key``.

Unlike ``rand()`` or ``randomSplit`` the outcome does not depend on how the
rows are partitioned, survives task retries, and can be recomputed in any SQL
engine that knows md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32
HASH_SPACE = 1 << HASH_BITS


def hash32(seed, *keys) -> Column:
    """32-bit unsigned hash of ``seed:key[:key...]`` as a bigint."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket(seed, n: int, *keys) -> Column:
    """Uniform bucket in ``[0, n)``."""
    return F.pmod(hash32(seed, *keys), F.lit(n).cast("bigint"))


def uniform(seed, *keys) -> Column:
    """Uniform double in ``[0, 1)``."""
    return hash32(seed, *keys) / F.lit(float(HASH_SPACE))
