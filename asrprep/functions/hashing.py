"""Engine-independent seeded hashes (md5 based), so Spark and any SQL engine agree on
sample membership and shuffle order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_md5(seed, *keys) -> Column:
    """``md5('<seed>:<k1>:<k2>...')`` as 32 lower-case hex characters; sorts like the number."""
    parts = [F.lit(str(seed))] + [_c(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def seeded_hash32(seed, *keys) -> Column:
    """First 32 bits of :func:`seeded_md5` as a non-negative bigint (0 .. 2**32-1)."""
    return F.conv(F.substring(seeded_md5(seed, *keys), 1, 8), 16, 10).cast("bigint")


def seeded_unit(seed, *keys) -> Column:
    """:func:`seeded_hash32` scaled to [0, 1)."""
    return seeded_hash32(seed, *keys) / F.lit(4294967296.0)
