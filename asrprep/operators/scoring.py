"""Word error rate: per-pair word edit counts and corpus WER (raw or normalised).

Word edits of a pair: every distinct word of the pair is mapped to one code point (from U+10000 on,
so up to ~1M distinct words per pair), both word sequences become strings of those code points, and
the built-in code-point ``levenshtein`` counts substitutions + insertions + deletions. Long pairs are
measured in a band around the diagonal (the built-in's threshold), which is made four times as wide until the distance lies in
it: the cost follows length times distance, not length squared. A pair with more distinct words than code points available uses an exact dynamic-programming fold instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.functions.text import normalize_for_scoring, scoring_words, strip

_BASE_CP = 0x10000
_MAX_DISTINCT = 0x10FFFF - _BASE_CP
SHORT = 64        # words of the longer side up to which the full matrix is cheap
_FIRST_BAND = 16


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cp_string(idx: Column) -> Column:
    """The single code point ``U+10000 + idx`` as a string."""
    return F.decode(F.unhex(F.lpad(F.hex(idx + F.lit(_BASE_CP)), 8, "0")), "UTF-32")


def _encode(words: Column, vocab: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: _cp_string(F.array_position(vocab, w))), "")


def _dp_distance(ref: Column, hyp: Column) -> Column:
    """Exact Levenshtein over two arrays by a row-by-row fold (slow path)."""
    init = F.sequence(F.lit(0), F.size(hyp))
    m = F.size(hyp)

    def row(prev, x):
        def cell(cur, j):
            best = F.least(F.element_at(prev, j + 1) + 1, F.element_at(cur, -1) + 1,
                           F.element_at(prev, j) + F.when(F.element_at(hyp, j) == x, 0).otherwise(1))
            return F.concat(cur, F.array(best))
        first = F.array(F.element_at(prev, 1) + 1)
        return F.when(m == 0, first).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), first, cell))

    return F.element_at(F.aggregate(ref, init, row), -1)


def banded_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two strings, by bands of 16, 64, 256, ... edits; the last one is wider than any distance."""
    bands = F.array(*[F.lit(_FIRST_BAND << k) for k in range(0, 28, 2)])
    return F.get(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda p: F.aggregate(
        bands, F.lit(-1), lambda found, band: F.when(found >= 0, found).otherwise(F.call_function("levenshtein", p["a"], p["b"], band)))), 0)


def word_edits(ref_words, hyp_words) -> Column:
    """Minimum word substitutions + deletions + insertions turning ``ref_words`` into ``hyp_words``."""
    r, h = _c(ref_words), _c(hyp_words)
    # bound once per pair: inside a lambda the expression itself would be evaluated for every word
    pair = F.struct(r.alias("r"), h.alias("h"), F.array_distinct(F.concat(r, h)).alias("vocab"))

    def edits(p: Column) -> Column:
        a, b = _encode(p["r"], p["vocab"]), _encode(p["h"], p["vocab"])
        short = F.greatest(F.size(p["r"]), F.size(p["h"])) <= SHORT
        fast = F.when(short, F.levenshtein(a, b)).otherwise(banded_distance(a, b))
        return F.when(F.size(p["vocab"]) <= F.lit(_MAX_DISTINCT), fast).otherwise(_dp_distance(p["r"], p["h"]))

    return F.get(F.transform(F.array(pair), edits), 0).cast("long")


def score_pairs(pairs: DataFrame, ref_col: str = "ref", hyp_col: str = "hyp", normalize: bool = False) -> DataFrame:
    """Add ``ref_words``, ``hyp_words`` (counts) and ``edits`` to a table of (reference, hypothesis)
    pairs. With ``normalize`` both sides go through the scoring normaliser first and pairs whose
    normalised reference is blank are dropped."""
    ref, hyp = F.col(ref_col), F.col(hyp_col)
    if normalize:
        pairs = (pairs.withColumn("_ref", normalize_for_scoring(F.coalesce(ref, F.lit(""))))
                 .withColumn("_hyp", normalize_for_scoring(F.coalesce(hyp, F.lit(""))))
                 .where(F.length(strip("_ref")) > 0))
    else:
        pairs = (pairs.withColumn("_ref", F.coalesce(ref, F.lit("")))
                 .withColumn("_hyp", F.coalesce(hyp, F.lit(""))))
    pairs = (pairs.withColumn("_rw", scoring_words("_ref")).withColumn("_hw", scoring_words("_hyp")))
    return (pairs.withColumn("edits", word_edits("_rw", "_hw"))
            .withColumn("ref_words", F.size("_rw").cast("long"))
            .withColumn("hyp_words", F.size("_hw").cast("long"))
            .drop("_ref", "_hyp", "_rw", "_hw"))


def corpus_wer(scored: DataFrame) -> DataFrame:
    """One row: ``wer`` = 100 * total edits / total reference words, with the totals."""
    agg = scored.agg(F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"),
                     F.count(F.lit(1)).alias("pairs"))
    return agg.select(
        F.round(F.try_divide(F.lit(100.0) * F.col("edits"), F.col("ref_words")), 6).alias("wer"),
        F.coalesce(F.col("edits"), F.lit(0)).cast("long").alias("edits"),
        F.coalesce(F.col("ref_words"), F.lit(0)).cast("long").alias("ref_words"),
        F.col("pairs").cast("long").alias("pairs"))
