"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``. Nulls,
empty texts, ties, repeated rows, empty tables and extra columns are treated as the operators'
docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asrprep.llm import exact_dedup, mixture_packing, rules, simhash, toxicity
from asrprep.llm.exprs import crc_mod, table
from asrprep.session import prepare_session, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    prepare_session(spark)
    return rules.keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among ``docs``, calls toxic go."""
    prepare_session(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space one stays."""
    prepare_session(spark)
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by near fingerprints one stays."""
    prepare_session(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens, sources mixed by their token shares."""
    prepare_session(spark)
    return mixture_packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("packing", pack),
]

#: The classifier, the fingerprint components and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
