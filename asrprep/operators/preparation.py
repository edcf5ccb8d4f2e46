"""The preparation job: backlog -> audio -> features -> labels -> feature table, batch and stream.

``prepare_rows`` is the one transformation both forms share. The loader (location -> bytes) and the
feature function (bytes -> (2-d float array, seconds)) are injected and must be picklable; a feature
function raises ``Reject(reason)`` to name its reason. Label ids come from a vocabulary table and are
joined to the manifest before any audio is loaded, so the wide feature rows are never shuffled.
Audio is held for ``rows_per_output`` rows at a time, whatever the size of the input batch.

Outcome of a row: the first of ``load_failed`` (the loader failed every try), ``audio_missing``,
``audio_undecodable`` / ``multi_channel`` / ``feature_error`` (from the feature function),
``text_missing``, ``text_blank``, ``tokenize_error`` (no label besides the special ids); else good.

The sink is one Parquet table partitioned by run (or micro-batch) and status. The ids of a run's good rows go to the
ledger beside it (``_ledger``), and the run counts, for readers of the table and of the ledger alike, when its one commit
record is written there: good and rejected rows become visible together or not at all, and a run that is
repeated replaces its own rows. Ids already done are found through the ledger's filters (``operators.ledger``).
"""

from __future__ import annotations

import time
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.operators import labels as lab
from asrprep.functions.text import clean_transcription
from asrprep.operators.ledger import Ledger
from asrprep.operators.manifest import AUDIO_MISSING, FEATURE_ERROR, TEXT_BLANK, TEXT_MISSING, TOKENIZE_ERROR, select_backlog

LOAD_FAILED = "load_failed"


class Reject(Exception):
    """Raised by a feature function; its text is the reject reason."""


def load(loader, location: str | None, tries: int, delay: float):
    """(bytes, failed) after at most ``tries`` calls."""
    for n in range(1, tries + 1):
        try:
            return loader(location), False
        except Exception:  # noqa: BLE001 - any loader failure is retried, then recorded
            if n < tries and delay:
                time.sleep(delay)
    return None, True


def _one(loader, featurise, location, tries, delay):
    """(features, seconds, reason) of one row."""
    data, failed = load(loader, location, tries, delay)
    if failed:
        return None, None, LOAD_FAILED
    if data is None or len(data) == 0:
        return None, None, AUDIO_MISSING
    try:
        features, seconds = featurise(bytes(data))
        return [np.asarray(x, np.float32) for x in features], float(seconds), None
    except Reject as e:
        return None, None, str(e)
    except Exception:  # noqa: BLE001 - the row is rejected, the job goes on
        return None, None, FEATURE_ERROR


def prepare_rows(todo: DataFrame, loader, featurise, vocab: DataFrame, id_col: str = "id", location_col: str = "new_audio_url",
                 text_col: str = "transcription", lower_case: bool = False, remove_punct: bool = False, tries: int = 3,
                 delay: float = 5.0, rows_per_output: int = 8) -> DataFrame:
    """``(id, input_features, input_length, labels, reject_reason)`` for every row of ``todo`` (unique ids)."""
    cleaned = clean_transcription(F.col(text_col), lower_case, remove_punct)
    text = todo.select(id_col, cleaned.alias("_text"))
    ids = lab.encode(text.where(F.col("_text").isNotNull()), vocab, [id_col], "_text")
    rows = todo.select(id_col, F.col(location_col).cast("string").alias("_location"),
                       F.when(F.col(text_col).isNull(), F.lit(TEXT_MISSING))
                       .when(F.length(cleaned) == 0, F.lit(TEXT_BLANK)).alias("_text_reason")).join(ids, id_col, "left")
    rows = rows.withColumn("_text_reason", F.coalesce(
        "_text_reason", F.when(F.coalesce(F.size("labels"), F.lit(0)) <= 2, F.lit(TOKENIZE_ERROR))))
    kind = todo.schema[id_col].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), rows_per_output):
                part = pdf.iloc[at:at + rows_per_output]
                got = [_one(loader, featurise, x, tries, delay) for x in part["_location"]]
                why = [a if a is not None else b for (_, _, a), b in zip(got, part["_text_reason"])]
                keep = [w is None for w in why]
                yield pd.DataFrame({
                    id_col: part[id_col], "input_features": [f if k else None for (f, _, _), k in zip(got, keep)],
                    "input_length": [s if k else None for (_, s, _), k in zip(got, keep)],
                    "labels": [x if k else None for x, k in zip(part["labels"], keep)], "reject_reason": why})

    return rows.mapInPandas(run, f"{id_col} {kind}, input_features array<array<float>>, input_length double, "
                                 "labels array<int>, reject_reason string")


def _sink(prepared: DataFrame, out_dir: str, run: str, done: Ledger, rows_per_file: int, id_col: str) -> None:
    """Writes the rows of a run, its ids, then its commit record; whatever an earlier try of the run left is replaced."""
    tagged = prepared.select("*", F.lit(run).alias("run"),
                             F.when(F.col("reject_reason").isNull(), F.lit("good")).otherwise(F.lit("rejected")).alias("status"))
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .option("maxRecordsPerFile", str(rows_per_file)).partitionBy("run", "status").parquet(out_dir))
    spark = prepared.sparkSession
    written = spark.read.schema(tagged.schema).parquet(out_dir).where((F.col("run") == run) & (F.col("status") == "good"))
    done.add(written.select(id_col), run, id_col)
    done.commit(run)


def ledger(spark: SparkSession, out_dir: str, id_type, **sizes) -> Ledger:
    """The ledger beside a prepared table."""
    return Ledger(spark, f"{out_dir.rstrip('/')}/_ledger", id_type, **sizes)


def prepared(spark: SparkSession, out_dir: str, status: str | None = "good") -> DataFrame:
    """The rows of committed runs: those with a status, or all (None)."""
    rows = spark.read.parquet(out_dir)
    runs = ledger(spark, out_dir, rows.schema[0].dataType).runs()
    rows = rows.where(F.col("run").isin(runs))
    return rows if status is None else rows.where(F.col("status") == status)


def prepare_features_batch(spark: SparkSession, manifest: DataFrame, out_dir: str, run: str, loader, featurise, vocab: DataFrame,
                           sample_size="Full", rows_per_file: int = 1000, id_col: str = "id", **options) -> None:
    """Prepares what the ledger lacks as ``run``. A crashed run leaves nothing visible and is simply repeated; one that is
    already committed is not run again."""
    done = ledger(spark, out_dir, manifest.schema[id_col].dataType)
    if run in done.runs():
        return
    todo = select_backlog(manifest, done, id_col, options.get("text_col", "transcription"), sample_size)
    _sink(prepare_rows(todo, loader, featurise, vocab, id_col, **options), out_dir, run, done, rows_per_file, id_col)


def prepare_features_stream(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint: str, loader, featurise,
                            vocab: DataFrame, rows_per_file: int = 1000, max_files_per_trigger: int = 1,
                            id_col: str = "id", **options) -> None:
    """The same over files as they arrive: each micro-batch is a run of the stream that ``checkpoint`` names, skips ids that others
    have done and keeps one row per id."""
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"

    def each(batch: DataFrame, number: int) -> None:
        prepare_features_batch(spark, batch.dropDuplicates([id_col]), out_dir, f"batch-{stream}-{number:09d}", loader, featurise,
                               vocab, "Full", rows_per_file, id_col, **options)

    (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(source_dir)
     .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
