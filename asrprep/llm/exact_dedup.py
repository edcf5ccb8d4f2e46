"""Exact deduplication by 128-bit content hash, with the bytes compared inside groups.

Texts are equal when identical after ``normalise`` (here: all ASCII white space deleted).
1. Texts are grouped by (md5, normalised text). Equal texts collapse inside each map task, so a
   group holding a third of all rows sends one row per task; each group keeps its size and its best row.
2. Because the text itself is part of the grouping key, two different texts with the same md5 stay
   two groups: this is the byte comparison. Hashes with two or more texts (collisions) are listed.
3. Rows find their group by the hash alone; rows under a colliding hash by the text itself.
Only hashes, ids and counts are shuffled in step 3 (AQE splits a hot hash; its group side is one row).

Of a group the row with the longest original text (code points) stays, then the smallest id (null
ids last). Defined cases: a null text counts as empty; all empty texts are one group; of rows repeated
with the same id those of the group's greatest length are all ``kept`` in ``groups``, and ``keep_one`` returns one of them; an empty
table gives an empty table; other columns are not read by ``groups`` and returned whole by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm.exprs import text_or_empty, without_ws
from asrprep.session import scratch_path


def md5_bytes(norm: Column) -> Column:
    return F.unhex(F.md5(norm.cast("binary")))


def _classes(docs: DataFrame, id_col: str, text_col: str, hash128) -> tuple[DataFrame, DataFrame]:
    """(classes without text, colliding hashes), written once to the shared folder."""
    text = text_or_empty(text_col)
    best = F.struct((-F.length(text)).alias("neg"), F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))
    rows = docs.select(without_ws(text).alias("norm"), best.alias("best")).withColumn("h", hash128(F.col("norm")))
    found = (rows.groupBy("h", "norm")
             .agg(F.count(F.lit(1)).alias("group_size"), F.min("best").alias("best"))
             .select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size",
                     F.col("best.id").alias("keep_id"), (-F.col("best.neg")).alias("keep_chars")))
    spark = docs.sparkSession
    path = scratch_path(spark, "exact-classes")
    found.write.parquet(path)
    classes = spark.read.parquet(path)
    collisions = classes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    return classes, collisions


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash128=md5_bytes) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``hash128`` maps the normalised text to its hash; tests pass a weak one to force collisions.
    """
    return _judged(docs, id_col, text_col, hash128).drop("keep_chars")


def _judged(docs: DataFrame, id_col: str, text_col: str, hash128=md5_bytes) -> DataFrame:
    classes, collisions = _classes(docs, id_col, text_col, hash128)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_cp"), without_ws(text).alias("norm"))
    rows = rows.withColumn("h", hash128(F.col("norm")))

    def result(joined: DataFrame) -> DataFrame:
        return joined.select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_cp") == F.col("keep_chars"))).alias("kept"),
            "text_sha256", "keep_chars")

    if collisions.isEmpty():
        return result(rows.drop("norm").join(classes, "h"))
    plain = classes.join(collisions, "h", "left_anti")
    hard = rows.join(collisions, "h", "left_semi")
    best = F.struct((-F.col("n_cp")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    mixed = (hard.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best"))
             .select("h", "norm", F.sha2("norm", 256).alias("text_sha256"), "group_size",
                     F.col("best.id").alias("keep_id"), (-F.col("best.neg")).alias("keep_chars")))
    return result(rows.drop("norm").join(plain, "h")).unionByName(result(hard.join(mixed, ["h", "norm"])))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with all their columns (packed in a struct meanwhile, so that
    they may have any names)."""
    path = scratch_path(docs.sparkSession, "exact-kept")
    (_judged(docs, id_col, text_col).where("kept").groupBy("doc_id", "text_sha256", "keep_chars")
     .agg(F.count(F.lit(1)).alias("copies")).write.parquet(path))
    kept = docs.sparkSession.read.parquet(path)
    text = text_or_empty(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                       F.sha2(without_ws(text), 256).alias("sha"), F.length(text).alias("n"))
    joined = rows.join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256")) & (F.col("n") == F.col("keep_chars")))
    once = joined.where("copies = 1").select("row.*")
    if kept.where("copies > 1").isEmpty():
        return once
    # one id twice and more with the same content and length: one of them
    return once.unionByName(joined.where("copies > 1").dropDuplicates(["doc_id", "text_sha256"]).select("row.*"))
