"""Bounded samples of labelled rows for the classifiers.

The bounds are parameters of the classifiers. Rows are taken in the order of a hash of the id, so a
sample is the same in every run and does not depend on how a table is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.session import pin

MAX_BYTES = 200_000


def sample_ids(rows: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """``n`` distinct ids of ``rows`` in hash order."""
    return (rows.select(id_col).where(F.col(id_col).isNotNull()).distinct()
            .orderBy(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), id_col).limit(n))


def texts(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_bytes: int = MAX_BYTES, max_total: int = 1 << 25) -> list[tuple]:
    """(id, text) of the given ids (a sample of bounded size) in hash order, as many as fit into ``max_total`` bytes, but one at
    least. Of several rows of an id the smallest text holds. Only a training sample leaves out texts over ``max_bytes``.
    What doesn't fit is never brought to the driver: the sample is written once, its lengths are read first."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    found = pin(docs.select(F.col(id_col).alias("id"), t.alias("text")).where(F.octet_length("text") <= max_bytes)
                .join(F.broadcast(ids.select(F.col(id_col).alias("id"))), "id").groupBy("id").agg(F.min("text").alias("text")))
    sizes = (found.select("id", F.octet_length("text").alias("n"))
             .orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("order")), "id").collect())
    taken, total = {}, 0
    for r in sizes:
        total += r["n"]
        if taken and total > max_total:
            break
        taken[r["id"]] = len(taken)
    if not taken:
        return []
    rows = found.where(F.col("id").isin(list(taken))).collect() if len(taken) < len(sizes) else found.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: taken[r[0]])


def one_label(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label): rows without a label are left out; of several for one id the largest holds."""
    return (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(id_col).agg(F.max(label_col).alias("label")))


def score_columns(fn, docs: DataFrame, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    return (docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"),
                        fn(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
