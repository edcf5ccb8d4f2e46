"""Size-checked broadcast.

``broadcast()`` is only safe for a side whose size is bounded. When the bound is not known from
the data model, the side is measured first (one aggregate over a small, usually pinned table:
row count and bytes of its string/binary values) and broadcast only when the estimated size is
below ``max_bytes``; otherwise the join stays a shuffle join (where AQE may still switch to a
broadcast from measured shuffle sizes, or split skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Every task builds the hash table from a broadcast side, so the bound is of the order of Spark's
# own broadcast default rather than of executor memory.
DEFAULT_MAX_BYTES = 16 << 20
DEFAULT_MAX_ROWS = 2_000_000
_ROW_OVERHEAD = 16   # hash-table entry and row header
_FIELD_BYTES = 8     # fixed-width slot per field


def _size_aggs(df: DataFrame):
    var = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)).alias(f"_b{i}") for i, c in enumerate(var)]
    return aggs, len(var)


def _estimate(df: DataFrame, values, n_var: int) -> tuple[int, int]:
    n = int(values["_n"])
    var_bytes = sum(int(values[f"_b{i}"]) for i in range(n_var))
    return n, n * (_ROW_OVERHEAD + _FIELD_BYTES * len(df.schema.fields)) + var_bytes


def estimated_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated in-memory bytes) of ``df``, measured in one aggregate."""
    aggs, n_var = _size_aggs(df)
    return _estimate(df, df.agg(*aggs).collect()[0].asDict(), n_var)


def pin_measured(df: DataFrame):
    """Pin ``df`` (reliable checkpoint) and measure its size in the same job through
    ``DataFrame.observe``; returns ``(pinned, rows, estimated_bytes)``."""
    from asrprep.session import pin

    aggs, n_var = _size_aggs(df)
    obs = Observation()
    pinned = pin(df.observe(obs, *aggs))
    n, size = _estimate(df, obs.get, n_var)
    return pinned, n, size


def broadcast_if_small(df: DataFrame, rows: int, size: int, max_bytes: int = DEFAULT_MAX_BYTES,
                       max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when an already measured size is below both bounds."""
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is measured below both bounds, else ``df`` unchanged."""
    n, size = estimated_bytes(df)
    return broadcast_if_small(df, n, size, max_bytes, max_rows)
