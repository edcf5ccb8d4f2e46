"""Parallelism guard for CPU-heavy row-wise work.

A small input file is one split, so every expression before the first shuffle would run in one
task. When a DataFrame has fewer partitions than the session's default parallelism, it is spread
round-robin over that many; a large input (thousands of splits) is left untouched, so at scale
this adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df
