"""Lazy read with a shuffle buffer: a bounded-buffer permutation of a stream of files.

The row that arrives at position p is due at ``p + h * buffer / 2^32``, h being a seeded hash of its key, and rows leave in the
order of (due, h, key). So a row waits for fewer than ``buffer`` others, stands fewer than ``buffer`` places from where it arrived, and
after n arrivals everything due before n can leave: later rows are due at n or after. What remains, ``buffer`` rows at most, is
carried to the next micro-batch as a table. The order depends on the arrivals, the seed and the epoch alone, not on
where micro-batches end, and it is found by a distributed sort of each micro-batch; nothing runs row after row.

    out/rows/batch_id=k/     rows that left in micro-batch k: their columns, ``position`` (arrival) and ``out_position``
    out/carry/batch_id=k/    rows that still wait after it
    out/state/batch_id=k/    how many have arrived and left

A micro-batch reads the state of the one before it and replaces its own folders, so a replay gives the same rows. Rows arrive
in the order of the files' time (the stream's own order), then path, then row number.

Defined cases: rows whose keys are equal are ordered by arrival; a null key counts as the text ``null``; no files give an
empty table; a buffer of one keeps the order. Columns of the stream may not be named ``position``, ``out_position``, ``batch_id`` or start with ``_``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from asrprep.functions.hashing import seeded_hash32
from asrprep.operators.ordering import with_global_index
from asrprep.session import pin
from asrprep.sources.io import path_exists

_PLACES = [StructField(n, LongType()) for n in ("position", "_due", "_h")]


def _key(key_col: str) -> Column:
    return F.coalesce(F.col(key_col).cast("string"), F.lit("null"))


def _leave(rows: DataFrame, key_col: str, left: int) -> DataFrame:
    """``out_position`` of rows that leave together after ``left`` others."""
    ranked = with_global_index(rows.withColumn("_k", _key(key_col)), ["_due", "_h", "_k", "position"], "_rank")
    return ranked.withColumn("out_position", F.col("_rank") + F.lit(left)).drop("_rank", "_due", "_h", "_k")


class LazyShuffle:
    def __init__(self, spark: SparkSession, source_dir: str, schema: StructType, out_dir: str, key_col: str, buffer: int = 500,
                 seed: int = 42, epoch: int = 0, files_a_batch: int = 1):
        if buffer < 1 or buffer >= 1 << 31:
            raise ValueError("buffer must lie between 1 and 2^31 - 1")
        self.spark, self.source_dir, self.schema, self.out_dir, self.key_col = spark, source_dir, schema, out_dir, key_col
        self.buffer, self.seed, self.epoch, self.files_a_batch = buffer, seed, epoch, files_a_batch
        self._placed = StructType(schema.fields + _PLACES)

    def _at(self, kind: str, batch_id: int | None = None) -> str:
        return os.path.join(self.out_dir, kind, *([] if batch_id is None else [f"batch_id={batch_id}"]))

    def _state(self, spark: SparkSession, batch_id: int) -> tuple[int, int]:
        if batch_id < 0:
            return 0, 0
        r = spark.read.parquet(self._at("state", batch_id)).collect()[0]
        return r["arrived"], r["left"]

    def _carry(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], self._placed)
        return spark.read.schema(self._placed).parquet(self._at("carry", batch_id))

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived, left = self._state(spark, batch_id - 1)
        new = with_global_index(batch, ["_time", "_path", "_row"], "position").drop("_time", "_path", "_row")
        h = seeded_hash32(self.seed, F.lit(self.epoch), _key(self.key_col))
        new = new.withColumn("position", F.col("position") + F.lit(arrived)).withColumn("_h", h).withColumn(
            "_due", F.col("position") + F.shiftright(F.col("_h") * F.lit(self.buffer), 32)).select(*self._placed.names)
        waiting = pin(self._carry(spark, batch_id - 1).unionByName(new))
        arrived += waiting.where(F.col("position") >= F.lit(arrived)).count()
        going = _leave(waiting.where(F.col("_due") < F.lit(arrived)), self.key_col, left)
        going.write.mode("overwrite").parquet(self._at("rows", batch_id))
        left += spark.read.parquet(self._at("rows", batch_id)).count()
        waiting.where(F.col("_due") >= F.lit(arrived)).write.mode("overwrite").parquet(self._at("carry", batch_id))
        (spark.createDataFrame([(arrived, left)], "arrived long, left long").coalesce(1)
         .write.mode("overwrite").parquet(self._at("state", batch_id)))
        self._forget(batch_id - 2)  # a replay needs the micro-batch before, no older one

    def _forget(self, batch_id: int) -> None:
        if batch_id >= 0:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(self._at("carry", batch_id))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def run(self, checkpoint: str) -> None:
        """Takes every file that is there and not yet taken, ``files_a_batch`` at a time."""
        m = F.col("_metadata")
        stream = (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", str(self.files_a_batch)).parquet(self.source_dir)
                  .select(*self.schema.names, m["file_modification_time"].alias("_time"), m["file_path"].alias("_path"), m["row_index"].alias("_row")))
        (stream.writeStream.foreachBatch(self._take).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    def rows(self, end: bool = True) -> DataFrame:
        """The rows that have left, in ``out_position`` order when sorted by it; with ``end`` also those that still wait, in the order
        in which they would leave if nothing came after. That changes no state: a later run goes on from the buffer."""
        if not path_exists(self.spark, self._at("state")):
            out = StructType(self.schema.fields + [StructField("position", LongType()), StructField("out_position", LongType())])
            return self.spark.createDataFrame([], out)
        last = self.spark.read.parquet(self._at("state")).agg(F.max("batch_id")).collect()[0][0]
        out = self.spark.read.parquet(self._at("rows")).where(F.col("batch_id") <= F.lit(last)).drop("batch_id")
        if not end:
            return out
        _, left = self._state(self.spark, last)
        return out.unionByName(_leave(self._carry(self.spark, last), self.key_col, left))
