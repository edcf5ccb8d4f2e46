"""The ledger of processed ids as a table in buckets, with a Bloom filter for each bucket and one commit record a run.

    path/ids/bucket=k/run=r/    the ids of run r whose hash falls in bucket k
    path/filters/version=n/     a filter of fixed size for every bucket: all ids of the first n additions
    path/commits/               a record for every run whose writes are all done

``unseen`` asks the filters first. Ids that the filter of their bucket doesn't know are new, so that usually no ledger file is
read at all; for the others only the files of their buckets are read, and those ids go to the ledger's files (a broadcast of
measured size), not the ledger to them. What a batch costs depends on its own size and on the filters', which is fixed by ``buckets`` and
``filter_bits``; not on how many batches went before. ``compact`` puts the ids of many runs together again.

A run counts once its record is written, which is one file renamed into place: a run that dies before has no effect on any
reader, and its repetition replaces what it left. Bits of such a run in a filter only cost a look at a file.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from asrprep.operators.joins import checked_broadcast
from asrprep.session import pin
from asrprep.sources.io import path_exists

PROBES = 4
_COMMIT = "seq long, run string, kind string"


def _probes(h: np.ndarray, bits: int):
    h = h.view(np.uint64)
    for k in range(PROBES):
        yield ((h + (h >> np.uint64(32)) * np.uint64(k)) & np.uint64(bits - 1)).astype(np.int64)


def _bits_of(h: np.ndarray, bits: int, old: bytes | None) -> np.ndarray:
    words = np.zeros(bits // 8, np.uint8) if old is None else np.frombuffer(old, np.uint8).copy()
    for p in _probes(h, bits):
        np.bitwise_or.at(words, p >> 3, (1 << (p & 7)).astype(np.uint8))
    return words


class Ledger:
    """``buckets`` and ``filter_bits`` (a power of two, for each bucket) are fixed when a ledger is made: some 10 bits an id expected in a
    bucket keep false alarms near one in a hundred; a fuller filter costs more reading, never a wrong answer."""

    def __init__(self, spark: SparkSession, path: str, id_type: DataType, buckets: int = 64, filter_bits: int = 1 << 20):
        if filter_bits & (filter_bits - 1) or filter_bits < 64:
            raise ValueError("filter_bits must be a power of two, 64 at least")
        self.spark, self.path, self.buckets, self.filter_bits = spark, path, buckets, filter_bits
        self.id_type = id_type.simpleString()

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def _log(self) -> list:
        """All commit records in order: a row a run."""
        if not path_exists(self.spark, self._at("commits")):
            return []
        return sorted(self.spark.read.schema(_COMMIT).json(self._at("commits")).collect())

    def runs(self) -> list[str]:
        """The committed runs, in order."""
        return [r["run"] for r in self._log() if r["kind"] == "run"]

    def _live(self) -> list[str]:
        """The runs that hold the ids: the last compaction and what came after."""
        log = self._log()
        base = max((i for i, r in enumerate(log) if r["kind"] == "base"), default=0)
        return [r["run"] for r in log[base:]]

    def ids(self, buckets: list[int] | None = None) -> DataFrame:
        """``(id, bucket, run)`` of the committed runs, of some buckets or of all; only their folders are listed."""
        live, schema = self._live(), f"id {self.id_type}, bucket int, run string"
        wanted = range(self.buckets) if buckets is None else buckets
        found = [p for k in wanted if path_exists(self.spark, p := self._at("ids", f"bucket={k}"))] if live else []
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self._at("ids")).parquet(*found).where(F.col("run").isin(live))

    def _filters(self) -> DataFrame | None:
        """``(bucket, bits)`` of the newest version that was written to its end."""
        folder = self._at("filters")
        if not path_exists(self.spark, folder):
            return None
        newest = self._version()
        return self.spark.read.schema("bucket int, bits binary").parquet(os.path.join(folder, f"version={newest:09d}")) if newest else None

    def _version(self) -> int:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self._at("filters"))
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        done = [int(n[8:]) for n in names if n.startswith("version=")
                and fs.exists(jvm.org.apache.hadoop.fs.Path(self._at("filters", n, "_SUCCESS")))]
        return max(done, default=0)

    def _keyed(self, rows: DataFrame, id_col: str) -> DataFrame:
        i = F.col(id_col).cast(self.id_type)
        return rows.select(i.alias("id"), F.xxhash64(i, F.lit(1)).alias("h"),
                           F.pmod(F.xxhash64(i), F.lit(self.buckets)).cast("int").alias("bucket")).where("id is not null")

    def seen(self, rows: DataFrame, id_col: str = "id") -> DataFrame:
        """``(id)``: the distinct ids of ``rows`` that are in the ledger."""
        filters, bits = self._filters(), self.filter_bits
        if filters is None:
            return self.spark.createDataFrame([], f"id {self.id_type}")

        def test(ids: pa.Table, known: pa.Table) -> pa.Table:
            out = ids.select(["id", "bucket"])
            if not known.num_rows:
                return out.slice(0, 0)
            h, words = ids.column("h").to_numpy(), np.frombuffer(known.column("bits")[0].as_py(), np.uint8)
            hit = np.ones(len(h), bool)
            for p in _probes(h, bits):
                hit &= (words[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            return out.filter(pa.array(hit))

        maybe = pin(self._keyed(rows, id_col).distinct().groupBy("bucket").cogroup(filters.groupBy("bucket"))
                    .applyInArrow(test, f"id {self.id_type}, bucket int"))
        hit = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())  # at most a number a bucket
        if not hit:
            return maybe.select("id")
        return self.ids(hit).join(checked_broadcast(maybe), ["id", "bucket"], "left_semi").select("id").distinct()

    def unseen(self, rows: DataFrame, id_col: str = "id") -> DataFrame:
        """The rows whose id is not in the ledger (a null id never is). The rows are moved only if the seen ids are too many to
        broadcast."""
        if self._version() == 0:
            return rows
        seen = pin(self.seen(rows, id_col)).withColumnRenamed("id", "__seen_id")
        return rows.join(checked_broadcast(seen), F.col(id_col).cast(self.id_type) == F.col("__seen_id"), "left_anti")

    def add(self, ids: DataFrame, run: str, id_col: str = "id") -> None:
        """Writes the ids of a run, and filters that know them; they count once ``commit`` is called."""
        keyed = self._keyed(ids, id_col).distinct().withColumn("run", F.lit(run)).repartition("bucket")
        (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "run").parquet(self._at("ids")))
        parts = [self._at("ids", f"bucket={k}", f"run={run}") for k in range(self.buckets)]
        parts = [p for p in parts if path_exists(self.spark, p)]
        if not parts:
            return
        keyed = (self.spark.read.schema(f"id {self.id_type}, h long, bucket int").option("basePath", self._at("ids")).parquet(*parts))
        bits, old = self.filter_bits, self._filters()
        if old is None:
            old = self.spark.createDataFrame([], "bucket int, bits binary")

        def build(ids: pa.Table, known: pa.Table) -> pa.Table:
            bucket = (ids if ids.num_rows else known).column("bucket")[0].as_py()
            words = _bits_of(ids.column("h").to_numpy() if ids.num_rows else np.zeros(0, np.int64), bits,
                             known.column("bits")[0].as_py() if known.num_rows else None)
            return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([words.tobytes()], pa.binary())})

        (keyed.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(build, "bucket int, bits binary")
         .write.mode("overwrite").parquet(self._at("filters", f"version={self._version() + 1:09d}")))

    def commit(self, run: str, kind: str = "run") -> None:
        """Makes a run's ids count. Committing a run again changes nothing."""
        log = self._log()
        if any(r["run"] == run for r in log):
            return
        (self.spark.createDataFrame([(len(log), run, kind)], _COMMIT).coalesce(1).write.mode("append").json(self._at("commits")))

    def compact(self) -> None:
        """Puts the ids of all committed runs together, a file a bucket. Readers see the runs' files or the new ones, never both."""
        base = f"base-{len(self._log()):09d}"
        (self.ids().select("id", F.xxhash64("id", F.lit(1)).alias("h"), "bucket").distinct().withColumn("run", F.lit(base)).repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "run").parquet(self._at("ids")))
        self.commit(base, "base")
