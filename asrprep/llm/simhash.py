"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64 bits from the hashes of word shingles. Two fingerprints at most ``max_bits`` = 3
bits apart differ in at most one bit of one of their two 32-bit segments. So each distinct
fingerprint is stored in one table per segment, and probes each table with the small Hamming ball
(radius 1) of its own segment; matches are verified by the complete distance. Of two segments one
bit apart only the one with the 0 probes for the other, which halves the probes and loses no pair.

Work runs on distinct fingerprints, so a group of equal documents is one entry. A table cell that
holds more than ``hot_cell`` distinct fingerprints is not paired out: its members meet instead at
the points of Hamming balls in the other segment (radius 2 against 1, and 1 against 1 for members
one bit away in this segment). Every pair within 3 bits shares such a point, all that meet there are
within 3 bits, and each is linked to the smallest fingerprint there only: exact, and linear in the
members. Components come from ``components.connected``.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is linked
like any other; with fewer words than a shingle the whole sequence is hashed; repeated rows fall in
one component; component ids are the smallest non-null document id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm import components
from asrprep.operators.joins import DEFAULT_MAX_ROWS, broadcast_if_small, estimated_bytes
from asrprep.session import pin

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT_CELL = 1024
HOT_ROOT = 1 << 20


def fingerprint_text(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint: bit i is 1 when set in over half of the shingle hashes."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space
    if not w:
        return 0
    parts = [w[i:] for i in range(shingle)] if len(w) >= shingle else [[b" ".join(w)]]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(b" ".join(s), seed) for s in zip(*parts)), np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(h[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([fingerprint_text(t, shingle) for t in s], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"))


def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * k).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def _flips(seg: Column, raising: bool = False) -> Column:
    """``seg`` with one of its 32 bits flipped; ``raising`` only with a 0 turned into 1."""
    bits = F.array(*[F.lit(1 << b).cast("long") for b in range(32)])
    if raising:
        bits = F.filter(bits, lambda b: seg.bitwiseAND(b) == 0)
    return F.transform(bits, lambda b: seg.bitwiseXOR(b))


def _ball(seg: Column, radius: int) -> Column:
    out = F.array(seg)
    if radius >= 1:
        out = F.concat(out, _flips(seg))
    if radius == 2:
        masks = [(1 << a) | (1 << b) for a in range(32) for b in range(a)]
        two = F.transform(F.sequence(F.lit(0), F.lit(len(masks) - 1)), lambda i: seg.bitwiseXOR(
            F.get(F.array(*[F.lit(m).cast("long") for m in masks]), i)))
        out = F.concat(out, two)
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL) -> DataFrame:
    """Edges (a, b), a != b, over the distinct fingerprints ``fps`` (column fp): every pair at most
    ``max_bits`` apart is joined by an edge or, inside a hot cell, by a path of edges."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments probed with radius 1 find pairs at most 3 bits apart")
    cells = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), _segment(F.col("fp"), k).alias("seg"), _segment(F.col("fp"), 1 - k).alias("other"))
        for k in (0, 1)])).alias("c")).select("fp", "c.*")
    probes = cells.select("fp", "k", "other", F.explode(F.concat(
        F.array(F.struct(F.lit(0).alias("off"), F.col("seg").alias("seg"))),
        F.transform(_flips(F.col("seg"), raising=True), lambda s: F.struct(F.lit(1).alias("off"), s.alias("seg"))),
    )).alias("p")).select("fp", "k", "other", "p.*")
    hot = pin(cells.groupBy("k", "seg").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_cell).select("k", "seg"))
    any_hot = not hot.isEmpty()

    def close(a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits

    table = cells.select(F.col("fp").alias("b"), "k", "seg")
    if any_hot:
        table = table.join(hot, ["k", "seg"], "left_anti")
    pairs = (probes.withColumnRenamed("fp", "a").join(table, ["k", "seg"])
             .where(((F.col("off") == 1) | (F.col("a") < F.col("b"))) & close("a", "b")).select("a", "b"))
    if any_hot:
        pairs = pairs.unionByName(_hot_links(cells.join(hot, ["k", "seg"], "left_semi"),
                                             probes.join(hot, ["k", "seg"], "left_semi").where("off = 1"), max_bits))
    return pairs.distinct()


def _hot_links(cells: DataFrame, near: DataFrame, max_bits: int) -> DataFrame:
    """Links inside hot cells and into them, through shared points of the other segment."""
    def meet(left: DataFrame, r_left: int, right: DataFrame, r_right: int) -> DataFrame:
        def spread(df: DataFrame, r: int, side: int) -> DataFrame:
            return df.select("fp", "k", "seg", F.explode(_ball(F.col("other"), r)).alias("at"), F.lit(side).alias("side"))

        rows = spread(left, r_left, 0).unionByName(spread(right, r_right, 1))
        least = (rows.groupBy("k", "seg", "at")
                 .agg(F.min(F.when(F.col("side") == 0, F.col("fp"))).alias("l"),
                      F.min(F.when(F.col("side") == 1, F.col("fp"))).alias("r"))
                 .where("l is not null and r is not null"))
        return (rows.join(least, ["k", "seg", "at"])
                .select(F.col("fp").alias("a"), F.when(F.col("side") == 0, F.col("r")).otherwise(F.col("l")).alias("b"))
                .where("a != b"))

    # with fewer bits the same ways hold with smaller balls: radii add up to the bits left in this segment
    inside = {3: (2, 1), 2: (1, 1), 1: (1, 0), 0: (0, 0)}[max_bits]
    edges = meet(cells, inside[0], cells, inside[1])
    if max_bits:
        into = {3: (1, 1), 2: (1, 0), 1: (0, 0)}[max_bits]
        edges = edges.unionByName(meet(near.drop("off"), into[0], cells, into[1]))
    return edges.distinct()


def _smallest_ids(linked: DataFrame, hot_root: int = HOT_ROOT, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """(fp, component_id) of ``linked`` (fp, first_id, root). A component of more than ``hot_root`` members isn't shuffled by its
    root: there are at most rows / ``hot_root`` of those, so they are broadcast. If all components together are small, all are."""
    least = pin(linked.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n")))
    rows, size = estimated_bytes(least)
    small = broadcast_if_small(least, rows, size, max_rows=max_rows)
    if small is not least:
        return linked.join(small, "root").select("fp", "component_id")
    hot = F.broadcast(least.where(F.col("n") > hot_root))
    return (linked.join(hot, "root").select("fp", "component_id")
            .unionByName(linked.join(hot.select("root"), "root", "left_anti").join(least, "root").select("fp", "component_id")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = pin(fingerprints(docs, id_col, text_col, shingle))
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components.connected(links(ids.select("fp"), max_bits, hot_cell), "a", "b")  # node, root
    # only fingerprints with a link need their component's smallest id; the others are their own component
    linked = pin(ids.join(roots, ids["fp"] == roots["node"]).select("fp", "first_id", "root"))
    smallest = _smallest_ids(linked)
    member = ids.join(smallest, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return (prints.join(member, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each near-duplicate group (the smallest id), with all its columns. Rows
    without an id are kept: no group can name them."""
    dropped = (near_groups(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle, max_bits)
               .where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct())
    kept = docs.join(dropped, id_col, "left_anti").select(*docs.columns)
    repeated = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").where(F.col(id_col).isNotNull())
    # rows repeated under one id are one document
    once = kept.join(repeated.select(id_col), id_col, "left_anti").select(*docs.columns)
    again = kept.join(repeated.select(id_col), id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col])
    return once.unionByName(again)
