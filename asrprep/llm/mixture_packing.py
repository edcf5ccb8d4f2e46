"""Mixture-controlled packing: deficit round-robin over source queues.

Every window (a sequence of up to ``length`` tokens) should hold each source's target share of
tokens. Sources are queues of documents; in each window every source earns its share as credit and,
in turn, hands over as many tokens as its credit, its queue and the window allow. Room left over is
shared among the queues that still hold tokens. What a source got too little or too much stays in its deficit,
which is carried to the next window, and from one group of documents to the next.

1. Texts are tokenised once, where they are read; ids go to a table in the shared folder under the
   number of the input partition. Tokens are counted per (partition, source).
2. A source's queue runs over all input partitions. A document's place in it (the tokens of its source before it:
   those of earlier partitions plus those earlier in its own) says when its turn comes at the target shares, and so
   its group: each group holds every source in its target share, however the table is sorted. Documents aren't
   split over groups, so a group's shares are off by up to a document of each source.
3. The deficits with which a group starts follow from the counts of the groups before it (a
   running sum per source over a small table), so groups are packed independently, by their documents' token
   counts alone. The ids don't go with a group: they meet their document's pieces in a join, a document a row.
4. Each group's windows are full, but for the last: the rest is cut into windows whose sizes are
   powers of two. So there is no padding at all.

By default the targets are the sources' shares of all tokens, which uses up all queues together.
Other targets steer every window while the queues last; sources without a target come last.

Defined cases: a null text counts as empty and still has its end id; a null source is a queue of its
own; repeated rows are packed each; very long documents are cut at window borders; an empty table
gives an empty table; columns other than id, text and source are not read.
"""

from __future__ import annotations

import collections
import functools
import math
import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asrprep.llm.tokens import WordEndIds, tokenizer_path
from asrprep.operators.joins import checked_broadcast
from asrprep.session import pin, scratch_path

LENGTH = 4096
END_ID = 2
GROUP_TOKENS = 8 << 20  # more groups than input partitions if groups would exceed this
_IDS = "part int, pos long, source string, doc_id {id}, before long, n_tokens long, ids binary"
_OUT = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, source string")
_PIECE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_PLACED = "part int, pos long, pieces array<struct<start: long, length: long, sequence_id: long, offset: long>>"
_BATCH_CHARS = 4 << 20


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(part, pos, source, doc_id, tokens of the source before it in the partition, n_tokens, ids as unsigned 16- or
    32-bit) of every document."""
    id_type = docs.schema[id_col].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, pos, queued = WordEndIds.of(tokenizer), TaskContext.get().partitionId(), 0, collections.Counter()
        for big in batches:
            step = max(1, int(big.num_rows * _BATCH_CHARS / max(1, big.nbytes)))
            for at in range(0, big.num_rows, step):  # bounded memory whatever the batch size
                b = big.slice(at, step)
                ids = [np.append(words.encode(t), np.uint32(end_id)) for t in b.column(1).to_pylist()]
                n, before = len(ids), []
                for source, x in zip(b.column(2).to_pylist(), ids):
                    before.append(queued[source])
                    queued[source] += len(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int32()), pa.array(range(pos, pos + n), pa.int64()), b.column(2), b.column(0),
                    pa.array(before, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([_narrow(x) for x in ids], pa.binary())],
                    names=["part", "pos", "source", "doc_id", "before", "n_tokens", "ids"])
                pos += n

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(source_col).cast("string").alias("source"))
    return rows.mapInArrow(encode, _IDS.format(id=id_type.simpleString()))


def _narrow(ids: np.ndarray) -> bytes:
    """16-bit ids marked by a leading 0 byte, or 32-bit ids after a 1 byte."""
    return b"\0" + ids.astype("<u2").tobytes() if ids.max() < 65536 else b"\1" + ids.astype("<u4").tobytes()


def _wide(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if ids[:1] == b"\1" else "<u2", offset=1).astype("<u4")


def window_sizes(total: int, length: int) -> list[int]:
    """Full windows, then the rest as descending powers of two."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def round_robin(left: np.ndarray, share: np.ndarray, deficit: np.ndarray, sizes: list[int]) -> tuple[list, np.ndarray]:
    """[(window, source, offset, tokens)] for queues of ``left`` tokens, and the final deficits.

    ``share`` sums to 1; ``sizes`` to the sum of ``left``.
    """
    takes, left, deficit, n = [], left.astype(np.int64).copy(), deficit.astype(float).copy(), len(left)
    for w, size in enumerate(sizes):
        deficit += size * share
        give = np.zeros(n, np.int64)
        room, turn = size, np.roll(np.arange(n), -w)
        due = np.minimum(np.floor(np.maximum(deficit, 0)), left).astype(np.int64)
        for s in turn.tolist():
            give[s] = min(due[s], room)
            room -= int(give[s])
        while room:  # queues ran dry, or credits are fractions: the others overdraw by their shares
            live = np.flatnonzero(left - give)
            weight = share[live] if share[live].sum() > 0 else np.ones(len(live))
            more = np.minimum(np.floor(room * weight / weight.sum()).astype(np.int64), (left - give)[live])
            if more.sum() == 0:
                most = int(live[np.argmax((deficit - give)[live])])
                give[most] += 1
                room -= 1
            else:
                give[live] += more
                room -= int(more.sum())
        left -= give
        deficit -= give
        at = 0
        for s in turn.tolist():
            if give[s]:
                takes.append([w, s, at, int(give[s])])
                at += int(give[s])
    return takes, deficit


def lay_out(rows: pa.Table, carry: pd.DataFrame, length: int) -> pa.Table:
    """The pieces of one group's documents (grp, part, pos, source, n_tokens), a list for each. ``carry``: source, share,
    deficit."""
    rows = rows.sort_by([("part", "ascending"), ("pos", "ascending")]).combine_chunks()
    group = rows["grp"][0].as_py()
    names = carry["source"].fillna("\0null").tolist()
    index = {s: i for i, s in enumerate(names)}
    queue_of = rows["source"].to_pandas().fillna("\0null").map(index).to_numpy()
    n_tokens = rows["n_tokens"].to_numpy()
    left = np.bincount(queue_of, weights=n_tokens, minlength=len(names)).astype(np.int64)
    share = carry["share"].to_numpy(float)
    takes, _ = round_robin(left, share / share.sum(), carry["deficit"].to_numpy(float), window_sizes(int(left.sum()), length))
    w, s, off, t = np.array(takes, np.int64).reshape(-1, 4).T
    out = []
    for q in np.unique(queue_of):
        docs, mine = np.flatnonzero(queue_of == q), np.flatnonzero(s == q)
        starts = np.concatenate([[0], np.cumsum(n_tokens[docs])])
        begins = np.concatenate([[0], np.cumsum(t[mine])])
        cuts = np.unique(np.concatenate([starts, begins]))  # at document and at window borders
        a, b = cuts[:-1], cuts[1:]
        d, k = np.searchsorted(starts, a, "right") - 1, np.searchsorted(begins, a, "right") - 1
        out.append((docs[d], a - starts[d], b - a, (group << 32) + w[mine[k]], off[mine[k]] + a - begins[k]))
    doc, *fields = map(np.concatenate, zip(*out))
    order = np.argsort(doc, kind="stable")
    values = pa.StructArray.from_arrays([pa.array(x[order], pa.int64()) for x in fields], fields=list(_PIECE))
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n_tokens)))])
    return pa.table({"part": rows["part"], "pos": rows["pos"], "pieces": pa.ListArray.from_arrays(ends.astype(np.int32), values)})


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece, with the checksum of its ids, from rows (doc_id, source, n_tokens, ids, pieces)."""
    for b in batches:
        lists = b.column("pieces")
        of, flat = lists.value_parent_indices(), lists.flatten()
        start, length, sequence, offset = (flat.field(f.name) for f in _PIECE)
        crcs, at, borders = [], 0, list(zip(start.to_pylist(), length.to_pylist()))
        for ids, n in zip(b.column("ids"), lists.value_lengths().to_pylist()):
            raw = memoryview(_wide(ids.as_py())).cast("B")
            crcs += [zlib.crc32(raw[4 * x:4 * (x + m)]) for x, m in borders[at:at + n]]
            at += n
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(of), start, length, pa.array(crcs, pa.int64()), b.column("n_tokens").take(of), sequence,
             offset, b.column("source").take(of)], names=[x.split()[0] for x in _OUT.split(", ")])


def with_group(ids: DataFrame, counts: DataFrame, total: int, groups: int, targets: dict[str, float] | None) -> DataFrame:
    """``ids`` with ``grp``, 0 to ``groups`` - 1: how many of all tokens are due before the document, by the targets.

    With a target t, a document's turn comes at its source's tokens before it / t, and of every source as
    many tokens are due by then as its own t allows, at most all. ``counts``: part, source, n.
    """
    of_source = Window.partitionBy("source")
    queues = counts.select(
        F.col("part").alias("_part"), F.col("source").alias("_source"), F.sum("n").over(of_source).alias("_all"),
        F.coalesce(F.sum("n").over(of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    place = F.col("_earlier") + F.col("before")
    due = place / F.col("_all") * F.lit(float(total))
    weights = {k: float(v) for k, v in (targets or {}).items() if v > 0}
    if weights:
        sizes = {r["source"]: float(r["n"]) for r in counts.where(F.col("source").isin(*weights)).groupBy("source")
                 .agg(F.sum("n").alias("n")).collect()}  # a row per target
        aimed = sum(sizes.values())
        due = F.lit(aimed) + place / F.col("_all") * F.lit(total - aimed)  # without a target: after all others
        if sizes:
            turn = place / F.element_at(F.create_map(*[x for k in sizes for x in (F.lit(k), F.lit(weights[k]))]), F.col("source"))
            by_then = [F.least(F.lit(n), F.lit(weights[k]) * turn) for k, n in sizes.items()]
            due = F.when(F.col("source").isin(*sizes), functools.reduce(operator.add, by_then)).otherwise(due)
    grp = F.least(F.floor(due / F.lit(float(max(1, total))) * F.lit(groups)), F.lit(groups - 1)).cast("long")
    return (ids.join(checked_broadcast(queues), (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("grp", grp).drop("_part", "_source", "_all", "_earlier", "before"))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """One row per piece of a document: where its ids start and how many, and where they lie."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-ids")
    (token_table(docs, tokenizer or tokenizer_path("word_bpe_49k.json"), end_id, id_col, text_col, source_col)
     .write.option("compression", "zstd").parquet(path))
    counts = pin(spark.read.parquet(path).groupBy("part", "source").agg(F.sum("n_tokens").alias("n")))
    total, parts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct("part")).collect()[0]
    groups = max(1, parts, math.ceil(total / GROUP_TOKENS))
    documents, sizes = (with_group(spark.read.parquet(path).select("part", "pos", "source", "before", "n_tokens"), counts, total,
                                   groups, targets) for _ in range(2))
    shares = counts.groupBy("source").agg(F.sum("n").alias("all"))
    if targets:
        weight = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
        shares = shares.withColumn("all", F.coalesce(F.element_at(weight, F.col("source")), F.lit(0.0)))
    # what each group starts with: a source's due from all groups before, less what it gave there.
    # Both running sums are over tables with a row per group (and source), not over documents.
    held = sizes.groupBy("grp", "source").agg(F.sum("n_tokens").alias("n"))
    totals = held.groupBy("grp").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("grp", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("all_before"))
    gave = Window.partitionBy("source").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    mine = held.select("grp", "source", F.coalesce(F.sum("n").over(gave), F.lit(0)).alias("gave"))
    grand = shares.agg(F.sum("all")).collect()[0][0] or 1
    shares = shares.select(F.col("source").alias("_source"), (F.col("all") / F.lit(float(grand))).alias("share"))
    carry = (mine.join(shares, F.col("source").eqNullSafe(F.col("_source"))).join(totals, "grp")
             .select("grp", "source", "share", (F.col("share") * F.col("all_before") - F.col("gave")).alias("deficit")))

    def each(rows: pa.Table, start: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "pos": pa.array([], pa.int64()), "pieces": pa.array([], pa.list_(_PIECE))})
        here = start.to_pandas().sort_values("source")
        if here["share"].sum() <= 0:
            here = here.assign(share=1.0)
        return lay_out(rows, here, length)

    # groups hold no ids, only their numbers; each document's ids then meet its pieces, row by row
    placed = documents.groupBy("grp").cogroup(carry.groupBy("grp")).applyInArrow(each, _PLACED)
    rows = spark.read.parquet(path).select("part", "pos", "doc_id", "source", "n_tokens", "ids").join(placed, ["part", "pos"])
    return (rows.select("doc_id", "source", "n_tokens", "ids", "pieces")
            .mapInArrow(checksums, _OUT.format(id=docs.schema[id_col].dataType.simpleString())))
