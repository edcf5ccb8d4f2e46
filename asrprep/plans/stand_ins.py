"""Readers for the driver's tables and their mapping onto this library's logical tables.

* ``conversations(conv_id, turn, role, text)`` stands in for transcript *chunks*: recording =
  ``conv_id``, chunk order = ``turn``, transcription = ``text``. Test corrections are derived from
  each turn's own words ``w`` (1-based, ``n = size(w)``): at positions ``i < n`` with
  ``(i - 1) % 9 == 0`` the pair ``{wrong: w[i], correct: w[i+1]}``, and at positions with
  ``(i - 1) % 9`` in (3, 6) the pair ``{wrong: w[i], correct: rotate(w[i+1])}`` where ``rotate`` moves
  the first character to the end (such words rarely occur in the text, so flags and removals occur).
* ``documents(doc_id, text, lang, source, n_chars)`` stands in for the preparation *manifest*;
  ``labels(doc_id, ...)`` for the ledger of processed ids.
* ``pages(page_id, url, html)`` stands in for URL lists.
* ``embeddings(vec_id, embedding, label)`` stands in for PCM sample arrays.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.functions.corrections import corrections_literal
from asrprep.functions.text import words
from asrprep.operators.partitioning import ensure_parallelism

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; spread over the session's parallelism when the file is a single split."""
    return ensure_parallelism(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def _rotate(w):
    return F.concat(F.substring(w, 2, 1 << 30), F.substring(w, 1, 1))


def derived_corrections(words_col: str = "_w"):
    w = F.col(words_col)
    n = F.size(w)
    positions = F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                         lambda i: (i < n) & ((i - 1) % 9).isin(0, 3, 6))
    return F.transform(positions, lambda i: F.struct(
        F.element_at(w, i).alias("wrong"),
        F.when((i - 1) % 9 == 0, F.element_at(w, i + 1)).otherwise(_rotate(F.element_at(w, i + 1))).alias("correct")))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations + a ``corrections`` literal column (the stored string form)."""
    conv = table(spark, sf_dir, "conversations")
    return (conv.withColumn("_w", words("text"))
            .withColumn("corrections", corrections_literal(derived_corrections("_w")))
            .drop("_w"))


CHUNK_KEYS = ["conv_id", "turn"]
CHUNK_COLS = dict(audio_col="conv_id", order_col="turn", text_col="text", corrections_col="corrections")
