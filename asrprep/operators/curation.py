"""Correction curation: corpus statistics, per-correction criteria, row verdict, ordered rewrite.

Input is a *chunks* table: one row per transcript chunk with a row key, an ``audio_id`` (the
recording), an ``order`` (chunk position), the ``transcription`` and a ``corrections`` literal.

Shape of the job (every step a DataFrame operation, no driver loops):

* word statistics: explode words -> ``groupBy(word).count()`` (partial + final hash aggregate)
* pair statistics: explode corrections -> ``groupBy(wrong, correct).count()``; similarity computed on
  that distinct-pair table only; known-word flag by a join with the word statistics
* "correct word appears in the recording's full transcript": decided without building the full
  transcript per row. For a correct word made only of word characters, every occurrence in the
  space-joined transcript lies inside one word of one chunk, so it is a whole-token equi-join, or,
  for the rest, an equi-join against the substrings (of the needed lengths only) of the recording's
  distinct words. Corrections containing other characters are looked up in one pass over the
  transcripts of those recordings, which a filter of the corrections goes along with (``containment``).
* verdict: flags regrouped per row (a group is one row's own correction list)
* rewrite: a left join of the verdict to the rows, then a fold over the approved corrections.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asrprep.functions import corrections as corr
from asrprep.functions.similarity import similarity as similarity_expr
from asrprep.functions.text import WORD, words
from asrprep.operators.containment import candidates
from asrprep.operators.joins import broadcast_if_small, checked_broadcast, pin_measured
from asrprep.operators.ordering import with_group_index
from asrprep.session import pin as pin_df

PURE_WORD = rf"^{WORD}\z"  # not $, which also matches before a final line end


def word_frequency(df: DataFrame, text_col: str = "transcription") -> DataFrame:
    """Lower-cased word counts over the corpus; null text contributes nothing."""
    return (df.select(F.explode(words(F.col(text_col), lower=True)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def known_words(word_freq: DataFrame, min_word_freq: int = 3) -> DataFrame:
    return word_freq.where(F.col("freq") >= F.lit(min_word_freq))


def with_parsed_corrections(df: DataFrame, corrections_col: str = "corrections",
                            out_col: str = "corrections_list") -> DataFrame:
    return df.withColumn(out_col, corr.parse_corrections(corrections_col))


def correction_occurrences(parsed: DataFrame, key_cols: list[str], list_col: str = "corrections_list",
                           extra_cols: list[str] = ()) -> DataFrame:
    """One row per correction: key, position, lower-cased wrong/correct."""
    # posexplode_outer + filter: an inner explode would infer a filter on the list and push it below
    # the projection that computes the list
    return (parsed.select(*key_cols, *extra_cols, F.posexplode_outer(list_col).alias("pos", "c"))
            .where(F.col("c").isNotNull())
            .select(*key_cols, *extra_cols, "pos",
                    F.lower(F.col("c.wrong")).alias("wrong"), F.lower(F.col("c.correct")).alias("correct")))


def correction_pair_frequency(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy("wrong", "correct").agg(F.count(F.lit(1)).alias("pair_frequency"))


def pair_statistics(occurrences: DataFrame, word_freq: DataFrame, min_word_freq: int = 3,
                    metric: str = "sequence") -> DataFrame:
    """Distinct pairs with frequency, similarity and the known-word flag of the correct word."""
    pairs = correction_pair_frequency(occurrences)
    known = known_words(word_freq, min_word_freq).select(F.col("word").alias("correct"),
                                                         F.lit(True).alias("is_correct_known"))
    return (pairs.withColumn("similarity", similarity_expr("wrong", "correct", metric))
            .join(known, "correct", "left")
            .withColumn("is_correct_known", F.coalesce(F.col("is_correct_known"), F.lit(False))))


def full_transcripts(df: DataFrame, audio_col: str = "audio_id", order_col: str = "order",
                     text_col: str = "transcription", tie_cols: list[str] = (), bucket_width: int = 1024) -> DataFrame:
    """Chunk texts of each recording joined by one space in chunk order; null texts skipped; null
    order last; ties by ``tie_cols``. Rows with a null recording id form no group.

    Two levels, so a recording with very many chunks is not one aggregation group: chunks are first
    joined inside order ranges of ``bucket_width`` (a hot recording spreads over many groups and
    tasks), then each recording joins its ordered pieces (one per range). The result is one string
    per recording by definition.
    """
    bucket = F.when(F.col(order_col).isNull(), F.lit(None)).otherwise(F.floor(F.col(order_col) / F.lit(bucket_width)))
    parts = F.struct(F.col(order_col).isNull().alias("o_null"), F.col(order_col).alias("o"),
                     *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_cols)],
                     F.col(text_col).cast("string").alias("text"))
    pieces = (df.where(F.col(audio_col).isNotNull())
              .withColumn("_b", bucket.cast("long"))
              .groupBy(audio_col, "_b")
              .agg(F.array_sort(F.collect_list(parts)).alias("_parts"),
                   F.count(F.col(text_col)).alias("_n"))
              .select(audio_col, "_b",
                      F.when(F.col("_n") > 0, F.concat_ws(" ", F.transform("_parts", lambda p: p["text"])))
                      .alias("_piece")))
    ordered = F.struct(F.col("_b").isNull().alias("b_null"), F.col("_b").alias("b"), F.col("_piece").alias("piece"))
    return (pieces.groupBy(audio_col)
            .agg(F.array_sort(F.collect_list(ordered)).alias("_pieces"))
            .select(audio_col, F.concat_ws(" ", F.transform("_pieces", lambda p: p["piece"])).alias("full_transcription")))


def recording_word_counts(df: DataFrame, audio_col: str = "audio_id", text_col: str = "transcription") -> DataFrame:
    """``(recording, word, n)``: lower-cased word counts per recording (a null recording is its own
    group). One pass over the text gives both the corpus word frequencies (sum over recordings)
    and each recording's distinct words."""
    return (df.select(audio_col, F.explode(words(F.col(text_col), lower=True)).alias("word"))
            .groupBy(audio_col, "word").agg(F.count(F.lit(1)).alias("n")))


def appears_in_transcript(chunks: DataFrame, occurrences: DataFrame, audio_col: str = "audio_id",
                          text_col: str = "transcription", order_col: str = "order",
                          tie_cols: list[str] = (), pin: bool = True, tokens: DataFrame | None = None) -> DataFrame:
    """Distinct ``(audio_id, correct)`` with ``appears`` = correct is a substring of the lower-cased
    full transcript of the recording, for non-empty words of non-null recordings (the empty word
    always appears; any other word never appears for a null recording id: the caller handles both)."""
    cw = (occurrences.select(audio_col, "correct")
          .where((F.length("correct") > 0) & F.col(audio_col).isNotNull()).distinct())
    pure = cw.where(F.col("correct").rlike(PURE_WORD))
    other = cw.where(~F.col("correct").rlike(PURE_WORD))

    if tokens is None:  # distinct (recording, word); callers that have word counts pass them in
        tokens = (chunks.where(F.col(audio_col).isNotNull())
                  .select(audio_col, F.explode(words(F.col(text_col), lower=True)).alias("tok"))
                  .distinct())
        if pin:  # read by two joins; computed once
            tokens = pin_df(tokens)
    # one left join marks the words that occur as a whole word of the recording
    marked = (pure.join(tokens.select(audio_col, F.col("tok").alias("correct"), F.lit(True).alias("_whole")),
                        [audio_col, "correct"], "left")
              .select(audio_col, "correct", F.coalesce("_whole", F.lit(False)).alias("_whole")))
    if pin:
        marked = pin_df(marked)
    rest = marked.where(~F.col("_whole")).select(audio_col, "correct")
    # substrings of the recording's words, only of the lengths still asked for in that recording
    # (linear in the text: at most one substring per character and asked-for length)
    lens = rest.select(audio_col, F.length("correct").alias("L")).distinct()
    if pin:  # the partitioned word table drives the generation; the small length table is the build side
        lens = checked_broadcast(lens)
    # positions exploded first, then a plain substring: no lambda, so it stays in generated code
    subs = (tokens.join(lens, audio_col)
            .where(F.length("tok") > F.col("L"))
            .select(audio_col, "tok", "L", F.explode(F.sequence(F.lit(1), F.length("tok") - F.col("L") + 1)).alias("j"))
            .select(audio_col, F.expr("substring(tok, j, L)").alias("correct")))
    # probe the substrings against the remaining words: the words are the build side (broadcast when
    # a count shows they are small), so the substrings are not shuffled in that case; a semi join
    # needs no distinct on the probe side
    hit_sub = subs.join(checked_broadcast(rest) if pin else rest, [audio_col, "correct"], "left_semi").distinct()

    def found(asked: DataFrame, hits: DataFrame) -> DataFrame:
        return (asked.join(hits.withColumn("appears", F.lit(True)), [audio_col, "correct"], "left")
                .withColumn("appears", F.coalesce("appears", F.lit(False))))

    out = (marked.where("_whole").select(audio_col, "correct", F.lit(True).alias("appears"))
           .unionByName(found(rest, hit_sub)))
    # corrections with non-word characters, if there are any
    other, other_rows, _ = pin_measured(other)
    if not other_rows:
        return out
    texts = _stretches(chunks, other, audio_col, text_col, order_col, tie_cols, pin)
    hit_other = candidates(pin_df(texts) if pin else texts, other, other_rows, audio_col).distinct()
    return out.unionByName(found(other, hit_other))


STRETCH = 256  # chunks of a stretch


def _stretches(chunks: DataFrame, other: DataFrame, audio_col: str, text_col: str, order_col: str,
               tie_cols: list[str], pin: bool) -> DataFrame:
    """``(audio_id, _b, _t)``: the lower-cased transcripts as stretches of ``STRETCH`` chunks, each with the
    beginning of what follows, as long as the recording's longest correction less one character.

    So every occurrence of a correction lies whole in the stretch in which it starts, and no row holds more than
    that of a recording. Chunks are numbered by range partitions, so a hot recording is not one task's.
    """
    need = other.groupBy(audio_col).agg(F.max(F.length("correct")).alias("_need"))
    texts = (chunks.where(F.col(text_col).isNotNull())
             .join(checked_broadcast(need) if pin else need, audio_col)
             .select(audio_col, "_need", F.col(text_col).cast("string").alias("_t"), F.col(order_col).alias("_o"),
                     *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_cols)]))
    order = [F.col("_o").asc_nulls_last(), *[F.col(f"_t{i}").asc() for i in range(len(tie_cols))], F.col("_t").asc()]
    if pin:
        placed = with_group_index(texts, [audio_col], order, "_i")
    else:
        placed = texts.withColumn("_i", F.row_number().over(Window.partitionBy(audio_col).orderBy(*order)) - 1)
    pieces = (placed.groupBy(audio_col, F.floor(F.col("_i") / STRETCH).alias("_b"))
              .agg(F.max("_need").alias("_need"), F.array_sort(F.collect_list(F.struct("_i", "_t"))).alias("_parts"))
              .select(audio_col, "_b", "_need", F.lower(F.concat_ws(" ", F.transform("_parts", lambda p: p["_t"]))).alias("_t")))
    if pin:
        pieces = pin_df(pieces)
    # a full stretch and the space after it are STRETCH characters at least, so this many of the next are enough
    ahead = F.greatest(F.lit(1), F.ceil((F.col("_need") - 1) / STRETCH)).cast("int")
    tails = (pieces.select(audio_col, "_b", "_need", "_t", F.explode(F.sequence(F.lit(1), ahead)).alias("_k"))
             .where(F.col("_b") >= F.col("_k"))
             .select(audio_col, (F.col("_b") - F.col("_k")).alias("_b"), F.struct("_k", F.left(
                 "_t", F.greatest(F.lit(0), F.col("_need") - 1 - (F.col("_k") - 1) * STRETCH).cast("int")).alias("_h")).alias("_h"),
                 "_need")
             .groupBy(audio_col, "_b").agg(F.array_sort(F.collect_list("_h")).alias("_h"))
             .select(audio_col, "_b", F.concat_ws(" ", F.transform("_h", lambda h: h["_h"])).alias("_tail")))
    return (pieces.join(tails, [audio_col, "_b"], "left")
            .select(audio_col, "_b", F.concat_ws(" ", "_t", "_tail").alias("_t")))


def flag_rule(pair_frequency: Column, similarity: Column, known: Column, appears: Column,
              min_pair_freq: int = 2, similarity_threshold: float = 0.7) -> Column:
    """A correction is flagged when it is rare, dissimilar, not to a known word and not seen in the
    recording's transcript."""
    return ((pair_frequency < F.lit(min_pair_freq)) & (similarity < F.lit(similarity_threshold))
            & ~known & ~appears)


@dataclass
class Curation:
    rows: DataFrame        # input + n_corrections, n_flagged, approved, reject_reason, verdict
    audit: DataFrame       # one row per correction with every criterion and the flag
    kept: DataFrame        # rows judged KEEP, transcription rewritten, other columns untouched
    removed: DataFrame     # rows judged REMOVE
    rejects: DataFrame     # rows whose corrections could not be parsed
    word_freq: DataFrame
    pair_stats: DataFrame


def parse_once(df: DataFrame, key_cols: list[str], audio_col: str, corrections_col: str,
               pin: bool = True) -> DataFrame:
    """The narrow occurrence table every later step reads: one row per correction (key, recording,
    pos, lower-cased wrong/correct) plus one marker row per unparsable row (``malformed``).

    Pinned with a reliable checkpoint in the shared checkpoint folder: the literal parse (with its
    Python fallback) runs once, the later branches read the pinned table, and the lineage is cut.
    """
    parsed = with_parsed_corrections(df.select(*key_cols, audio_col, corrections_col), corrections_col,
                                     "_list")
    occ = (parsed.select(*key_cols, audio_col, F.col("_list").isNull().alias("malformed"),
                         F.posexplode_outer("_list").alias("pos", "c"))
           .where(F.col("c").isNotNull() | F.col("malformed"))
           .select(*key_cols, audio_col, "malformed", "pos",
                   F.lower(F.col("c.wrong")).alias("wrong"), F.lower(F.col("c.correct")).alias("correct")))
    return pin_df(occ) if pin else occ


def curate(df: DataFrame, key_cols: list[str], audio_col: str = "audio_id", order_col: str = "order",
           text_col: str = "transcription", corrections_col: str = "corrections",
           min_pair_freq: int = 2, similarity_threshold: float = 0.7, min_word_freq: int = 3,
           metric: str = "sequence", remove_share: float = 0.5, pin: bool = True) -> Curation:
    """Judge every row's corrections and rewrite the kept rows. ``key_cols`` must identify a row
    (unique, non-null); the original has no row key, so the caller names one.

    A row is removed when flagged / max(1, n) > ``remove_share`` (strict). Word and pair statistics
    include rows that are later removed. Rows with an unparsable correction literal are rejected
    with ``malformed_corrections`` and contribute to no pair statistic.
    """
    key_cols = list(key_cols)
    occ_all = parse_once(df, key_cols, audio_col, corrections_col, pin)
    occ = occ_all.where(~F.col("malformed")).drop("malformed")
    bad = occ_all.where(F.col("malformed")).select(*key_cols, F.lit(True).alias("_malformed"))
    # one pass over the text: per-recording word counts give the corpus frequencies and the
    # recordings' distinct words
    aw = recording_word_counts(df, audio_col, text_col)
    if pin:
        aw = pin_df(aw)
    wf = aw.groupBy("word").agg(F.sum("n").alias("freq"))
    tokens = aw.where(F.col(audio_col).isNotNull()).select(audio_col, F.col("word").alias("tok"))
    stats = pair_statistics(occ, wf, min_word_freq, metric)
    if pin:  # similarity (a Python UDF for 'sequence') computed once per distinct pair; measured in the same job
        stats, stats_rows, stats_bytes = pin_measured(stats)
    appears = appears_in_transcript(df, occ, audio_col, text_col, order_col, key_cols, pin, tokens=tokens)

    # a hot pair would skew a shuffle join on (wrong, correct): broadcast the distinct-pair table
    # when its counted size allows
    audit = (occ.join(broadcast_if_small(stats, stats_rows, stats_bytes) if pin else stats, ["wrong", "correct"], "inner")
             .join(appears, [audio_col, "correct"], "left")
             .withColumn("appears_in_full_transcription",
                         (F.length("correct") == 0) | F.coalesce(F.col("appears"), F.lit(False)))
             .drop("appears")
             .withColumn("flagged", flag_rule(F.col("pair_frequency"), F.col("similarity"),
                                              F.col("is_correct_known"), F.col("appears_in_full_transcription"),
                                              min_pair_freq, similarity_threshold)))

    per_row = (audit.groupBy(*key_cols)
               .agg(F.count(F.lit(1)).alias("n_corrections"),
                    F.sum(F.col("flagged").cast("long")).alias("n_flagged"),
                    F.array_sort(F.collect_list(F.when(~F.col("flagged"), F.struct(
                        F.col("pos"), F.col("wrong"), F.col("correct"))))).alias("_approved"),
                    F.lit(None).cast("boolean").alias("_malformed"))
               .unionByName(bad.select(*key_cols, F.lit(None).cast("long").alias("n_corrections"),
                                       F.lit(None).cast("long").alias("n_flagged"),
                                       F.lit(None).cast("array<struct<pos:int,wrong:string,correct:string>>").alias("_approved"),
                                       "_malformed")))

    approved = F.coalesce(F.col("_approved"), F.array().cast("array<struct<pos:int,wrong:string,correct:string>>"))
    rows = (df.join(per_row, key_cols, "left")
            .withColumn("n_corrections", F.coalesce(F.col("n_corrections"), F.lit(0)).cast("long"))
            .withColumn("n_flagged", F.coalesce(F.col("n_flagged"), F.lit(0)).cast("long"))
            .withColumn("reject_reason", F.when(F.col("_malformed"), F.lit("malformed_corrections")))
            .withColumn("verdict", F.when(F.col("reject_reason").isNotNull(), F.lit("REJECT"))
                        .when(F.col("n_flagged") / F.greatest(F.lit(1), F.col("n_corrections")) > F.lit(remove_share),
                              F.lit("REMOVE"))
                        .otherwise(F.lit("KEEP")))
            .withColumn("approved", approved)
            .drop("_approved", "_malformed"))
    kept = (rows.where(F.col("verdict") == "KEEP")
            .withColumn(text_col, corr.apply_in_order(F.col(text_col), F.col("approved"))))
    return Curation(rows=rows, audit=audit, kept=kept,
                    removed=rows.where(F.col("verdict") == "REMOVE"),
                    rejects=rows.where(F.col("verdict") == "REJECT"),
                    word_freq=wf, pair_stats=stats)


def curated_table(df: DataFrame, key_cols: list[str], **kwargs) -> DataFrame:
    """The curated output: the kept rows with the input's columns only (rewritten transcription)."""
    res = curate(df, key_cols, **kwargs)
    return res.kept.select(*df.columns)


def rewritten(curation: Curation, text_col: str = "transcription") -> DataFrame:
    """Every parsed row with its approved corrections applied, whatever its verdict."""
    return curation.rows.where(F.col("reject_reason").isNull()).withColumn(
        text_col, corr.apply_in_order(F.col(text_col), F.col("approved")))
