"""Positions in the order in which rows stand in files: no sort and no exchange of the rows.

A row's position is the number of rows in the files before its own, plus its row number in its file, which the Parquet reader
gives. Files are ordered by their path, so the files of a table that Spark wrote sorted keep that order. Only one count per
file is gathered: running totals over the files come from range partitions, and the offsets are broadcast if they
are measured small, else joined by the path. The rows must come straight from a Parquet reader: columns may be selected before, but
a filter only after, since positions count all rows of the files; anything else is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asrprep.operators.joins import checked_broadcast
from asrprep.session import pin

_FILES_A_PARTITION = 100_000


def _check(scan: DataFrame) -> None:
    node = scan._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias"):
        node = node.children().apply(0)
    if not node.nodeName().startswith(("LogicalRelation", "RelationV2", "DataSourceV2Relation")):
        raise ValueError(f"positions need rows straight from a file reader, not from {node.nodeName()}")


def file_offsets(scan: DataFrame) -> tuple[DataFrame, int]:
    """(``_file``, ``_before``) for every file that holds rows, and the number of all rows. Reads no column."""
    _check(scan)
    files = pin(scan.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
                .groupBy("_file").agg((F.max("_row") + 1).alias("_n")))
    n_files = files.count()
    # runs of neighbouring files; what reaches the driver is a total for every 100,000 files
    part = F.spark_partition_id()
    ranged = pin(files.repartitionByRange(1 + n_files // _FILES_A_PARTITION, "_file").withColumn("_part", part))
    totals = sorted((r["_part"], r["t"]) for r in ranged.groupBy("_part").agg(F.sum("_n").alias("t")).collect())
    starts, total = [], 0
    for p, t in totals:
        starts.append((p, total))
        total += t
    before = F.sum("_n").over(Window.partitionBy("_part").orderBy("_file")) - F.col("_n")
    start = scan.sparkSession.createDataFrame(starts or [(0, 0)], "_part int, _start long")
    offsets = ranged.join(F.broadcast(start), "_part").select("_file", (F.col("_start") + before).alias("_before"))
    return offsets, total


def with_file_index(scan: DataFrame, index_col: str = "idx", offsets: DataFrame | None = None) -> DataFrame:
    """Adds ``index_col``, the 0-based position of each row over all files of ``scan``. Columns of ``scan`` may not be named
    ``_file``, ``_row`` or ``_before``."""
    _check(scan)
    if offsets is None:
        offsets, _ = file_offsets(scan)
    placed = scan.select(*scan.columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return (placed.join(checked_broadcast(pin(offsets)), "_file")
            .select(*scan.columns, (F.col("_before") + F.col("_row")).alias(index_col)))


def batches_in_file_order(scan: DataFrame, batch_size: int = 1000, sub_batch_size: int | None = 32) -> DataFrame:
    """Fixed-size batches of the rows as they stand in the files: ``idx``, ``batch_id``, ``sub_batch`` (place in the batch by
    ``sub_batch_size``)."""
    out = with_file_index(scan, "idx").withColumn("batch_id", F.floor(F.col("idx") / F.lit(batch_size)).cast("long"))
    if sub_batch_size:
        out = out.withColumn("sub_batch", F.floor(F.pmod(F.col("idx"), F.lit(batch_size)) / F.lit(sub_batch_size)).cast("long"))
    return out


def interleave_scans(scans: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Round-robin over the named scans in the given order, each read in file order: ``pos`` in its own scan, ``seq`` over all. Only
    whole rounds come back. The sizes are known from the files' offsets; nothing is counted again."""
    if not scans:
        raise ValueError("no scans to interleave")
    placed, sizes = [], []
    for k, (name, scan) in enumerate(scans.items()):
        offsets, n = file_offsets(scan)
        sizes.append(n)
        placed.append(with_file_index(scan, "pos", offsets).withColumn(split_col, F.lit(name))
                      .withColumn("seq", F.col("pos") * F.lit(len(scans)) + F.lit(k)))
    return reduce(DataFrame.unionByName, [p.where(F.col("pos") < F.lit(min(sizes))) for p in placed])
