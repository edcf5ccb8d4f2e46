"""Chunks of documents and questions about their distinct keys.

Operators that need a value per word (or word pair) of every text would shuffle every occurrence.
Here a task groups what it reads into chunks of bounded size, and sends each chunk's *distinct*
keys to the shard that owns them, as one compressed block per (chunk, shard). Shards answer with one
block per chunk that asked, and the chunk's documents (a block of key numbers) meet the answers in a
cogroup. A word that a third of all rows hold is one key per chunk; blocks are spread by key hash.

``keyed`` sends both kinds of blocks through one exchange, by the chunk or the shard, which Spark
writes once and reads for both uses in a query. Functions then skip the kind that is not theirs (a
filter would be pushed below the exchange and make it two). ``saved`` writes them to the shared folder.
A lost executor's blocks are made again by its tasks, the same ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from asrprep.session import scratch_path

CHUNK_BYTES = 14 << 20
SHARD_BYTES = 8 << 20
BLOCK = "key long, chunk long, shard int, block binary"


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed block; bytes of equal rank lie together, so small numbers shrink."""
    parts = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [a.dtype.str.encode().ljust(4), len(a).to_bytes(8, "little"),
                  a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=level).compress(b"".join(parts))


def unpack(block: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 2, []
    for _ in range(int.from_bytes(raw[:2], "little")):
        kind, n = np.dtype(raw[at:at + 4].decode().strip()), int.from_bytes(raw[at + 4:at + 12], "little")
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def pack_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(map(len, words), np.int32, len(words)), np.frombuffer(b"".join(words), np.uint8)


def unpack_words(lengths: np.ndarray, joined: np.ndarray) -> list[bytes]:
    raw, ends = joined.tobytes(), np.cumsum(lengths).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def shards_for(spark, df: DataFrame) -> int:
    """Number of shards, in proportion to the input's size as Spark estimates it from its files."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return int(min(max(12, size // SHARD_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1 << 20))


def batched(batches: Iterator[pa.RecordBatch], text_col: int, size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(chunk number, record batches) of what one task reads; numbers are unique over tasks."""
    number, held, used = TaskContext.get().partitionId() << 24, [], 0
    for b in batches:
        step = max(1, b.num_rows * (4 << 20) // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            n = int(pa.compute.sum(pa.compute.binary_length(part.column(text_col))).as_py() or 0)
            if held and used + n > size:
                yield number, held
                number, held, used = number + 1, [], 0
            held.append(part)
            used += n
    if held:
        yield number, held


def blocks(rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """Runs ``fn`` on each task's batches: (chunk, shard, block), the shard -1 for a block of documents. The
    result has a row per block, and a ``key``: the chunk, or -1 - shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, shard, block in fn(batches):
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk if shard < 0 else -1 - shard], pa.int64()), pa.array([chunk], pa.int64()),
                pa.array([shard], pa.int32()), pa.array([block], pa.binary())], names=["key", "chunk", "shard", "block"])

    return rows.mapInArrow(run, BLOCK)


def keyed(rows: DataFrame, fn) -> DataFrame:
    """``blocks`` partitioned by key, for two uses in one query."""
    return blocks(rows, fn).repartition("key")


def saved(rows: DataFrame, fn, name: str) -> DataFrame:
    """``blocks`` written once to the shared folder, for uses in several queries."""
    path = scratch_path(rows.sparkSession, name)
    blocks(rows, fn).write.option("compression", "none").parquet(path)
    return rows.sparkSession.read.schema(BLOCK).parquet(path)


def by_shard(shard_of: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of the keys of each shard that has any."""
    order = np.argsort(shard_of, kind="stable")
    ends = np.cumsum(np.bincount(shard_of, minlength=shards))
    for s in np.unique(shard_of).tolist():
        yield s, order[ends[s - 1] if s else 0:ends[s]]
