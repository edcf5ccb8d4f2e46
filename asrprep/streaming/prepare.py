"""Resumable, micro-batched preparation with Structured Streaming.

A file source over the manifest folder, ``trigger(availableNow=True)`` and a checkpoint location:
a re-run processes only files not seen before, a crash resumes from the last committed batch.
``foreachBatch`` writes each micro-batch into its own ``batch_id=<n>`` partition with dynamic
overwrite, so a replayed batch replaces its own output: exactly once per batch. The processed-id
ledger is derived from the output, so there is no second write that could disagree with it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from asrprep.operators.manifest import prepare_text
from asrprep.session import pin
from asrprep.sources.io import path_exists


def one_table(folder: str, name: str) -> str:
    """The source of a stream over one table of a folder of tables, which may be a file or a folder of files. Streams read
    folders, or all that a pattern matches: this one matches just ``name``. (``glob`` compares the names of files alone.)"""
    return os.path.join(folder, "{" + name + "}")


def prepare_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, id_col: str = "id",
                   text_col: str = "transcription", glob: str | None = None, max_files_per_trigger: int | None = None,
                   lower_case: bool = False, remove_punct: bool = False, fmt: str = "parquet", schema=None) -> None:
    """Run the preparation stream until every available file is processed, then stop. Writes
    ``good/``, ``rejects/`` and per-batch run ``counters/`` under ``out_dir``."""
    reader = spark.readStream.format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if schema is None:
        batch = spark.read.format(fmt)
        if glob:
            batch = batch.option("pathGlobFilter", glob)
        schema = batch.load(source_dir).schema
    stream = reader.schema(schema).load(source_dir)
    prepared = prepare_text(stream.where(F.col(text_col).isNotNull()), text_col, lower_case, remove_punct)

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        # one evaluation of the micro-batch feeds both writes (persisted for the batch only; a lost
        # block is recomputed from the file source, which replays the same rows); counters are
        # observed in the first write
        obs = Observation()
        tagged = batch_df.withColumn("batch_id", F.lit(int(batch_id))).observe(
            obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reject_reason").isNull()).alias("good")).persist()
        (tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(os.path.join(out_dir, "good")))
        (tagged.where(F.col("reject_reason").isNotNull()).select(id_col, "reject_reason", "batch_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(os.path.join(out_dir, "rejects")))
        tagged.unpersist()
        counts = obs.get
        (batch_df.sparkSession.createDataFrame(
            [(int(batch_id), int(counts["rows"]), int(counts["good"]), int(counts["rows"]) - int(counts["good"]))],
            "batch_id long, rows long, good long, rejected long")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(os.path.join(out_dir, "counters")))

    q = (prepared.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def prepared_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "good"))


def processed_ids(spark: SparkSession, out_dir: str, id_col: str = "id") -> DataFrame:
    """The ledger: ids present in the output (exactly the committed ones)."""
    return prepared_rows(spark, out_dir).select(id_col).distinct()


def run_label():
    """Wall-clock run label ``yyyyMMdd_HHmmss`` (the same for every row of a query)."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")


def prepare_batch(spark: SparkSession, manifest: DataFrame, out_dir: str, id_col: str = "id",
                  text_col: str = "transcription", sample_size="Full", lower_case: bool = False,
                  remove_punct: bool = False, rows_per_file: int = 1000):
    """Batch form of the resumable job: skip ids already in the output, take ``sample_size`` of the
    rest (after dropping null text), prepare, and append good rows and rejects under a ``run``
    partition. Re-running after a crash redoes only what was not committed; the ledger is the
    output itself (``processed_ids``). Returns the prepared rows and the run counters
    (``rows``, ``good``, ``text_blank``)."""
    from asrprep.operators.manifest import select_backlog

    good_dir = os.path.join(out_dir, "good")
    if path_exists(spark, good_dir):  # an output that cannot be read fails the job: its rows are not prepared again
        done = spark.read.parquet(good_dir).select(id_col)
    else:
        done = spark.createDataFrame([], manifest.select(id_col).schema)
    todo = select_backlog(manifest, done, id_col, text_col, sample_size)
    prepared = prepare_text(todo, text_col, lower_case, remove_punct).withColumn("run", run_label())
    # run counters gathered while the rows are computed (no extra job)
    counters = Observation("prepare_batch")
    prepared = prepared.observe(counters, F.count(F.lit(1)).alias("rows"),
                                F.count_if(F.col("reject_reason").isNull()).alias("good"),
                                F.count_if(F.col("reject_reason") == "text_blank").alias("text_blank"))
    prepared = pin(prepared)  # one evaluation feeds both writes
    (prepared.where(F.col("reject_reason").isNull()).drop("reject_reason")
     .write.mode("append").option("maxRecordsPerFile", str(rows_per_file)).partitionBy("run").parquet(good_dir))
    (prepared.where(F.col("reject_reason").isNotNull()).select(id_col, "reject_reason", "run")
     .write.mode("append").partitionBy("run").parquet(os.path.join(out_dir, "rejects")))
    return prepared, counters.get
