"""Dense global positions without an un-partitioned window.

Two passes, as ``zipWithIndex`` does: range-partition and sort on the key, pin the result with a
reliable checkpoint (so both passes see the same partitions), count rows per partition, and add
each partition's offset to the row's position inside its partition. Only the per-partition
counts (one row per partition, a proven bound) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.operators.joins import checked_broadcast
from asrprep.session import pin

_PID_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | record number in partition


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_index(df: DataFrame, order_by: list, index_col: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based position of the row in ``order_by`` order.

    ``order_by`` must be a total order (end it with a unique key); it may contain Columns with
    ``.asc()/.desc()``. Work is spread over ``num_partitions`` range partitions.
    """
    n = _partitions(df, num_partitions)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    # reliable checkpoint: written to the shared checkpoint folder, cuts lineage, and fixes the
    # partition contents for both passes (and survives the loss of an executor)
    pinned = pin(ordered)
    mid = F.monotonically_increasing_id()
    tagged = (pinned.withColumn("_mid", mid)
              .withColumn("_pid", F.shiftright("_mid", _PID_SHIFT).cast("int")))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    offsets, running = [], 0
    for row in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((int(row["_pid"]), running))
        running += int(row["_n"])
    spark = df.sparkSession
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PID_SHIFT)
    out = (tagged.join(F.broadcast(off_df), "_pid", "left")
           .withColumn(index_col, (F.coalesce(F.col("_off"), F.lit(0)) + local).cast("long"))
           .drop("_mid", "_pid", "_off"))
    return out


def with_group_index(df: DataFrame, group_by: list[str], order_by: list, index_col: str = "idx",
                     num_partitions: int | None = None) -> DataFrame:
    """0-based position inside each group. One hot group is spread over many range partitions
    (the range key is ``group_by + order_by``), so a group holding a third of the rows is not one task.

    The group's start is the minimum global position of its rows: a small per-group table joined
    back (AQE broadcasts it when small, or splits skewed partitions of a shuffle join).
    """
    gi = with_global_index(df, list(group_by) + list(order_by), "_gidx", num_partitions)
    starts = gi.groupBy(*group_by).agg(F.min("_gidx").alias("_gstart"))
    return (gi.join(checked_broadcast(starts), list(group_by), "inner")
            .withColumn(index_col, (F.col("_gidx") - F.col("_gstart")).cast("long"))
            .drop("_gidx", "_gstart"))
