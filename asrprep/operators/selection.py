"""The k first rows in the order of some columns, without sorting or moving the rows.

The value at rank k is found from histograms: the cells of the first pass are prefixes of the values (strings) or equal ranges
(whole numbers), the next pass looks only into the cell where rank k falls, and so on until that cell is small enough to be
ranked itself. The result is then a filter on the input. Rows that tie with the rank-k value are cut by the next
column in the same way; rows that tie in all columns, which nothing tells apart, by their place in a pinned table.

A pass is one aggregate with a bounded number of cells; at most ``SMALL`` values are ever ranked in one task. Nulls come first.
Where all partitions' first k rows together are at most ``MERGE`` rows, Spark's own top-k (ranked by partition, merged in one
task) gives the same rows in one job and is used instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, ByteType, IntegerType, LongType, ShortType, StringType

from asrprep.session import pin

SMALL = 10_000
MERGE = 1 << 18
CELLS = 1 << 12
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_PID_SHIFT = 33


def _rank_small(values: DataFrame, rank: int):
    """The value at ``rank`` (from 1) of at most a few cells' values."""
    return values.orderBy("v").limit(rank).agg(F.max("v")).collect()[0][0]


def _of_cells(counts: list[tuple], rank: int):
    """(cell, rows before it, rows in it) of the cell that holds ``rank``."""
    before = 0
    for cell, n in sorted(counts):
        if before + n >= rank:
            return cell, before, n
        before += n
    raise ValueError("the rank is beyond the rows")


def _whole_at(values: DataFrame, rank: int):
    low, high = values.agg(F.min("v"), F.max("v")).collect()[0]
    while low < high:
        width = -(-(high - low + 1) // CELLS)
        cell = F.expr(f"(cast(v AS decimal(20, 0)) - {low}BD) div {width}BD")  # exact: no rounding, no overflow
        inside = values.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        k, before, n = _of_cells([(int(r[0]), r[1]) for r in inside.groupBy(cell.alias("c")).count().collect()], rank)
        low, high, rank = low + k * width, min(high, low + (k + 1) * width - 1), rank - before
        if n <= SMALL:
            inside = values.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
            return _rank_small(inside, rank)
    return low


def _bytes_at(values: DataFrame, rank: int, step: int):
    """By prefixes that grow by ``step`` bytes; a cell that ends before them holds one value."""
    prefix = b""
    while True:
        b = F.col("v").cast("binary")
        inside = values.where(F.substring(b, 1, len(prefix)) == F.lit(prefix)) if prefix else values
        cell = F.substring(b, len(prefix) + 1, step)
        k, before, n = _of_cells([(bytes(r[0]), r[1]) for r in inside.groupBy(cell.alias("c")).count().collect()], rank)
        prefix, rank = prefix + k, rank - before
        same = values.where(F.substring(b, 1, len(prefix)) == F.lit(prefix))
        if len(k) < step:  # the value ends here; longer ones with the prefix lie in cells of their own
            return prefix
        if n <= SMALL:
            return _rank_small(same, rank)


def value_at(df: DataFrame, column: Column, rank: int, step: int = 2):
    """The value at ``rank`` (from 1) among the non-null values of ``column``."""
    values = df.select(column.alias("v")).where(F.col("v").isNotNull())
    kind = values.schema["v"].dataType
    if isinstance(kind, _WHOLE):
        return _whole_at(values, rank)
    if isinstance(kind, (StringType, BinaryType)):
        v = _bytes_at(values, rank, step)
        return v.decode() if isinstance(kind, StringType) and isinstance(v, (bytes, bytearray)) else v
    return _rank_small(values, rank)


def any_rows(df: DataFrame, k: int) -> DataFrame:
    """``k`` rows, whichever: the first ones of a pinned table by partition. Only row counts reach the driver."""
    pinned = pin(df).withColumn("_mid", F.monotonically_increasing_id())
    pid = F.shiftright("_mid", _PID_SHIFT).cast("int")
    counts = sorted((r[0], r[1]) for r in pinned.groupBy(pid.alias("p")).count().collect())
    whole, left = [], k
    for p, n in counts:
        if n > left:
            place = F.col("_mid") - F.shiftleft(F.lit(p).cast("long"), _PID_SHIFT)
            return pinned.where((pid < p) | ((pid == p) & (place < left))).drop("_mid")
        whole.append(p)
        left -= n
    return pinned.drop("_mid")


def first_rows(df: DataFrame, order: list[Column], k: int, step: int = 2) -> DataFrame:
    """The ``k`` first rows of ``df`` in ascending ``order`` (all if it has no more), in no particular order. ``df`` is read a
    few times: pin it if it is expensive. ``step``: bytes a pass for a first column of strings, 4 for hexadecimal digits."""
    if k <= 0:
        return df.limit(0)
    if not order:
        return any_rows(df, k)
    if k * df.rdd.getNumPartitions() <= MERGE:
        return df.orderBy(*order).limit(k)
    column, rest = order[0], order[1:]
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(column.isNull())).collect()[0]
    if n <= k:
        return df
    if nulls >= k:
        return first_rows(df.where(column.isNull()), rest, k)
    cut = F.lit(value_at(df, column, k - nulls, step))
    before, ties = df.agg(F.count_if(column < cut), F.count_if(column == cut)).collect()[0]
    if nulls + before + ties == k:
        return df.where(column.isNull() | (column <= cut))
    return df.where(column.isNull() | (column < cut)).unionByName(
        first_rows(df.where(column == cut), rest, k - nulls - before))
