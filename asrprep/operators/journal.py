"""Enrichment with a journal of answers, so that an answer that was paid for is never asked for again.

    journal/calls/run=<r>/part=<p>/<attempt>-<call>.jsonl    what one call answered, written by the task as soon as it came
    journal/final-<n>/                                       the whole set, written by ``compact``; the last complete one counts

A task writes the answers of each call as one file of JSON lines (under a hidden name first, then renamed) and goes on. If its
executor is lost, the next attempt reads the files of its own part of the run and asks only for what is missing: the pending rows are
pinned first, so that a part holds the same rows in every attempt. If the whole job dies, the next run reads the journal with
Spark, and only keys without an answer are pending. Keys without an answer (refused, or the call failed) have a line
too, with the error; it doesn't count as an answer, so they are asked again by the next run.

One key is asked once in a run, also when it stands in many rows. The journal must lie in a folder that executors can write
(any file system that pyarrow opens: local, shared mount, HDFS, S3, GCS). Keys and values are strings; a null key or
value gets no call.

Defined cases: no rows give an empty table; of several answers to one key (two attempts at once) the smallest holds, so readers
agree; an empty or missing journal answers nothing; of several values under one key the smallest is asked.
"""

from __future__ import annotations

import json
import os

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.operators.enrich import _call
from asrprep.session import pin
from asrprep.sources.io import path_exists, write_jsonl

LINE = "key string, value string, answer string, attempts int, error string"


def _store(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _lines_of(store, folder: str) -> list[dict]:
    """The lines of an earlier attempt's calls."""
    from pyarrow import fs

    out = []
    for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if f.is_file and f.base_name.endswith(".jsonl") and not f.base_name.startswith("_"):
            with store.open_input_stream(f.path) as src:
                out += [json.loads(x) for x in src.read().decode("utf-8").splitlines()]
    return out


def _write(store, folder: str, name: str, lines: list[dict]) -> None:
    hidden = f"{folder}/_{name}"
    with store.open_output_stream(hidden) as out:
        out.write("".join(json.dumps(x) + "\n" for x in lines).encode("utf-8"))
    store.move(hidden, f"{folder}/{name}")


class _Caller:
    """The work of one task: calls of ``batch_size`` values, a file for each."""

    def __init__(self, root: str, client, batch_size: int, max_retries: int, backoff):
        self.root, self.client, self.batch_size, self.max_retries, self.backoff = root, client, batch_size, max_retries, backoff

    def __call__(self, batches):
        store, base = _store(self.root)
        task = TaskContext.get()
        folder = f"{base}/part={task.partitionId():06d}"
        store.create_dir(folder, recursive=True)
        done = {x["key"] for x in _lines_of(store, folder)}
        calls = asked = 0
        wait: list[tuple] = []

        def ask() -> int:
            nonlocal wait
            now, wait = wait[:self.batch_size], wait[self.batch_size:]
            got, tries, error = _call(self.client, [v for _, v in now], self.max_retries, self.backoff)
            lines = [dict(key=k, value=v, answer=g, attempts=tries, error=None if g is not None else error or "no_result_for_key")
                     for (k, v), g in zip(now, got)]
            _write(store, folder, f"{task.taskAttemptId():012d}-{calls:06d}.jsonl", lines)
            return len(now)

        for pdf in batches:
            wait += [(k, v) for k, v in zip(pdf["key"], pdf["value"]) if k not in done]
            while len(wait) >= self.batch_size:
                asked += ask()
                calls += 1
        if wait:
            asked += ask()
            calls += 1
        yield pd.DataFrame({"calls": [calls], "asked": [asked]})


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def lines(self) -> DataFrame:
        """Every line of the journal with its run."""
        out = self.spark.createDataFrame([], LINE + ", run string")
        parts = [self._at(f"final-{n}") for n in self._finals()[-1:]]
        parts += [self._at("calls")] if path_exists(self.spark, self._at("calls")) else []
        for part in parts:
            out = out.unionByName(self.spark.read.schema(LINE + ", run string").json(part).select(*out.columns))
        return out

    def _folder(self, *parts: str):
        """The Hadoop file system and path of a part of the journal."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._at(*parts))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _finals(self) -> list[int]:
        """Numbers of the complete sets, oldest first."""
        fs, root = self._folder()
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(n[6:]) for n in names if n.startswith("final-") and path_exists(self.spark, self._at(n, "_SUCCESS")))

    def answers(self) -> DataFrame:
        """One line for each key: an answer if there is one (the earliest run, then the smallest), else its last error."""
        rank = F.struct(F.col("answer").isNull().alias("none"), F.col("run"), F.col("answer"), F.col("value"), F.col("attempts"), F.col("error"))
        best = (self.lines().groupBy("key").agg(F.min(rank).alias("first"), F.max(F.when(F.col("answer").isNull(), rank)).alias("last")))
        one = F.when(F.col("first.none"), F.col("last")).otherwise(F.col("first"))
        return best.select("key", one.alias("x")).select("key", "x.value", "x.answer", "x.attempts", "x.error", "x.run")

    def ask(self, rows: DataFrame, key_col: str, value_col: str, client, run: str, batch_size: int = 1000, max_retries: int = 5,
            backoff: tuple[float, float] | None = (1.0, 3.0), partitions: int | None = None) -> tuple[int, int]:
        """Asks for every key of ``rows`` that the journal doesn't answer; (calls, values asked). ``run`` names sort in the order of
        the runs; a run that died may be repeated under its name or go on under a new one."""
        wanted = (rows.select(F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"))
                  .where("key IS NOT NULL AND value IS NOT NULL").groupBy("key").agg(F.min("value").alias("value")))
        pending = wanted.join(self.answers().where("answer IS NOT NULL").select("key"), "key", "left_anti")
        if partitions:
            pending = pending.repartition(partitions, "key")
        pending = pin(pending)  # the same rows in the same part for every attempt
        # parts of an earlier run of this name held other rows, so each start has its own folder
        start = f"{run}~{self._starts(run):04d}"
        work = _Caller(self._at("calls", f"run={start}"), client, batch_size, max_retries, backoff)
        n = pending.mapInPandas(work, "calls long, asked long").agg(F.sum("calls").alias("calls"), F.sum("asked").alias("asked")).collect()[0]
        return n["calls"] or 0, n["asked"] or 0

    def _starts(self, run: str) -> int:
        k = 0
        while path_exists(self.spark, self._at("calls", f"run={run}~{k:04d}")):
            k += 1
        return k

    def compact(self) -> None:
        """Writes the journal's answers of now as the new final set, a line a key, then deletes older sets. The calls' files stay until
        ``forget_calls``."""
        old = self._finals()
        write_jsonl(self.answers(), self._at(f"final-{old[-1] + 1 if old else 0}"))
        for n in old:
            fs, p = self._folder(f"final-{n}")
            fs.delete(p, True)

    def forget_calls(self) -> None:
        """Deletes the calls' files, which a final set must hold; no run may be going on."""
        if not self._finals():
            raise RuntimeError("no final set: compact() first")
        kept = self.spark.read.schema(LINE).json(self._at(f"final-{self._finals()[-1]}")).where("answer IS NOT NULL").select("key")
        if not self.answers().where("answer IS NOT NULL").join(kept, "key", "left_anti").isEmpty():
            raise RuntimeError("answers newer than the final set: compact() first")
        fs, p = self._folder("calls")
        fs.delete(p, True)


def enrich_journaled(rows: DataFrame, key_col: str, value_col: str, client, journal: Journal, run: str, out_col: str = "result",
                     **options) -> DataFrame:
    """``rows`` with ``out_col``, ``attempts``, ``error`` and ``run`` (the run that answered) from the journal, after asking for what
    it lacks. All columns stay; a null key or value has the error ``value_missing``."""
    journal.ask(rows, key_col, value_col, client, run, **options)
    got = pin(journal.answers().select(F.col("key").alias("_key"), F.col("answer").alias(out_col), "attempts", "error",
                                       F.substring_index("run", "~", 1).alias("run")))
    keep = [c for c in rows.columns if c not in (out_col, "attempts", "error", "run")]
    lacks = F.col(key_col).isNull() | F.col(value_col).isNull()
    return (rows.select(*keep, F.when(~lacks, F.col(key_col).cast("string")).alias("_key")).join(got, "_key", "left")
            .select(*keep, out_col, F.coalesce("attempts", F.lit(0)).alias("attempts"),
                    F.when(lacks, F.lit("value_missing")).otherwise(F.col("error")).alias("error"), "run"))
