"""Registered curation queries over the driver's ``conversations`` table, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.functions.corrections import parse_corrections
from asrprep.functions.similarity import similarity
from asrprep.functions.text import words
from asrprep.operators import curation as cur
from asrprep.plans.stand_ins import CHUNK_COLS, CHUNK_KEYS, chunks, table

WORD_RE = r"[\p{L}\p{N}_]+"


def _curate(spark, sf_dir, metric="edit"):
    return cur.curate(chunks(spark, sf_dir), CHUNK_KEYS, metric=metric, **CHUNK_COLS)


def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.word_frequency(table(spark, sf_dir, "conversations"), "text")


def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.known_words(word_frequency(spark, sf_dir), min_word_freq=3)


def _occurrences(spark, sf_dir):
    occ = cur.parse_once(chunks(spark, sf_dir), CHUNK_KEYS, "conv_id", "corrections")
    return occ.where(~F.col("malformed"))


def correction_pair_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.correction_pair_frequency(_occurrences(spark, sf_dir))


def parse_corrections_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = chunks(spark, sf_dir).withColumn("cs", parse_corrections("corrections"))
    return ch.select("conv_id", "turn", F.posexplode_outer("cs").alias("pos", "c")).where(F.col("c").isNotNull()).select(
        "conv_id", "turn", F.col("pos").cast("long").alias("pos"),
        F.col("c.wrong").alias("wrong"), F.col("c.correct").alias("correct"))


def full_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.full_transcripts(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


def _pairs(spark, sf_dir, metric):
    pairs = cur.correction_pair_frequency(_occurrences(spark, sf_dir))
    return pairs.select("wrong", "correct", F.round(similarity("wrong", "correct", metric), 6).alias("similarity"))


def pair_similarity_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "sequence")


def pair_similarity_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "edit")


def correction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _curate(spark, sf_dir).audit
    return a.select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), "wrong", "correct",
                    F.col("pair_frequency").cast("long").alias("pair_frequency"),
                    F.round("similarity", 6).alias("similarity"), "is_correct_known",
                    "appears_in_full_transcription", "flagged")


def correction_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _curate(spark, sf_dir).rows
    return r.select("conv_id", "turn", "n_corrections", "n_flagged", "verdict")


def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _curate(spark, sf_dir)
    return cur.rewritten(res, "text").select("conv_id", "turn", "text")


def curate_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curate(spark, sf_dir).kept.select("conv_id", "turn", "role", "text")


def curate_transcripts_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curate(spark, sf_dir, metric="sequence").kept.select("conv_id", "turn", "role", "text")


def curate_nonword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether corrections with other than word characters occur in their recording: two words as
    spoken, hyphenated, with an apostrophe, parts of two words, separators alone.
    Every third conversation belongs to recording 0, which so holds a third of all rows."""
    conv = table(spark, sf_dir, "conversations").select(
        F.when(F.col("conv_id") % 3 == 0, 0).otherwise(F.col("conv_id")).alias("rec"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "text")
    w = F.col("_w")

    def forms(i):
        a, b = F.get(w, i), F.get(w, i + 1)
        return F.array(F.concat(a, F.lit(" "), b), F.concat(a, F.lit("-"), b), F.concat(a, F.lit("'"), b),
                       F.concat(F.right(a, F.lit(2)), F.lit(". "), F.left(b, F.lit(2))),
                       F.concat(F.right(a, F.lit(1)), F.lit(" "), b, F.lit(" ")), F.concat(a, F.lit(", ")), F.lit(" "), F.lit("--"))

    spots = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), lambda i: (i % 7 == 0) & (i + 1 < F.size(w)))
    occ = (conv.withColumn("_w", words("text", lower=True))
           .select("rec", F.explode(F.flatten(F.transform(spots, forms))).alias("correct")).distinct())
    return cur.appears_in_transcript(conv, occ, "rec", "text", "ord").select("rec", "correct", "appears")


def parse_corrections_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals of many forms made from each turn's first word: usual, escaped, other key order and
    more keys, text after the list, a bare object, a number, blank. ``n`` is -1 for malformed ones."""
    conv = table(spark, sf_dir, "conversations")
    first = F.coalesce(F.get(words("text"), F.lit(0)), F.lit("x"))
    k = (F.col("conv_id") + F.col("turn")) % 8
    usual = F.concat(F.lit("[{'wrong': '"), first, F.lit("', 'correct': 'c'}]"))
    raw = (F.when(k == 0, usual).when(k == 1, F.concat(F.lit("[{'wrong': '"), first, F.lit(r"""\x41\xa0\101', 'correct': "it's"}]""")))
           .when(k == 2, F.concat(F.lit("[{'correct': 'c', 'more': 1, 'wrong': '"), first, F.lit("'},]")))
           .when(k == 3, F.concat(usual, F.lit(" x"))).when(k == 4, F.concat(F.lit("{'wrong': '"), first, F.lit("', 'correct': 'c'}")))
           .when(k == 5, F.concat(F.lit("[{'wrong': '"), first, F.lit("', 'correct': 5}]"))).when(k == 6, F.lit(" \t\n")))
    got = conv.select("conv_id", "turn", parse_corrections(raw).alias("c"))
    return got.select("conv_id", "turn", F.coalesce(F.size("c"), F.lit(-1)).cast("long").alias("n"),
                      F.get("c", F.lit(0))["wrong"].alias("wrong"), F.get("c", F.lit(0))["correct"].alias("correct"))


# ---------------------------------------------------------------------------------------------
# SQL oracles (DuckDB dialect). Same derivation of test corrections as ``stand_ins.chunks``.

_BASE = rf"""
cw AS (SELECT conv_id, turn, role, text, regexp_extract_all(text, '{WORD_RE}') AS w FROM conversations),
ch AS (
  SELECT conv_id, turn, role, text,
         list_transform(list_filter(range(1, len(w)), lambda i: (i - 1) % 9 IN (0, 3, 6)),
           lambda i: {{'wrong': w[i], 'correct': CASE WHEN (i - 1) % 9 = 0 THEN w[i + 1]
                                             ELSE substring(w[i + 1], 2) || substring(w[i + 1], 1, 1) END}}) AS cs
  FROM cw),
occ AS (
  SELECT conv_id, turn, pos - 1 AS pos, lower(c.wrong) AS wrong, lower(c.correct) AS correct
  FROM (SELECT conv_id, turn, unnest(cs) AS c, generate_subscripts(cs, 1) AS pos FROM ch)),
wf AS (SELECT word, count(*) AS freq
       FROM (SELECT unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS word FROM conversations)
       GROUP BY word),
pairs AS (SELECT wrong, correct, count(*) AS pair_frequency FROM occ GROUP BY wrong, correct)
"""


def edit_distance_sql(a: str, b: str) -> str:
    """Levenshtein distance on code points as a DuckDB list DP (DuckDB's own counts bytes)."""
    r = f"regexp_extract_all({a}, '(?s).')"
    h = f"regexp_extract_all({b}, '(?s).')"
    return (f"list_last(list_reduce({r}, lambda prev, x: list_reduce(range(1, len({h}) + 1), "
            f"lambda cur, j: list_append(cur, least(prev[j + 1] + 1, cur[j] + 1, prev[j] + if({h}[j] = x, 0, 1))), "
            f"[prev[1] + 1]), range(0, len({h}) + 1)))")


def edit_similarity_sql(a: str, b: str) -> str:
    return (f"CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 "
            f"ELSE 1.0 - ({edit_distance_sql(a, b)})::DOUBLE / greatest(length({a}), length({b})) END")


# Longest matching blocks, split left and right of each, as the default similarity defines them: per
# region of a pair the longest common run, the earliest in the first text, then in the second
# (encoded as one number), its length given to the region's left part.
_RUN = """list_max(flatten(list_transform(range(alo, ahi), lambda i: list_transform(range(blo, bhi), lambda j:
  len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda k: substring(wrong, i + 1, k) = substring(correct, j + 1, k)))
  * 1000000 + (999 - i) * 1000 + (999 - j)))))"""
_SEQUENCE = f""",
regions(wrong, correct, alo, ahi, blo, bhi, k) AS (
  SELECT wrong, correct, 0::BIGINT, length(wrong), 0::BIGINT, length(correct), 0::BIGINT FROM pairs
  UNION ALL
  SELECT wrong, correct, unnest([alo, i + k]), unnest([i, ahi]), unnest([blo, j + k]), unnest([j, bhi]), unnest([k, 0])
  FROM (SELECT *  EXCLUDE (k, e), e // 1000000 AS k, 999 - e // 1000 % 1000 AS i, 999 - e % 1000 AS j
        FROM (SELECT *, {_RUN} AS e FROM regions WHERE alo < ahi AND blo < bhi) WHERE e >= 1000000)),
sequence AS (SELECT wrong, correct, CASE WHEN length(wrong) + length(correct) = 0 THEN 1.0
                    ELSE 2.0 * sum(k) / (length(wrong) + length(correct)) END AS similarity
             FROM regions GROUP BY wrong, correct)
"""


def _audit(similarity: str, extra: str = "", join: str = "") -> str:
    return _BASE + extra + rf""",
known AS (SELECT word FROM wf WHERE freq >= 3),
ps AS (SELECT p.wrong, p.correct, p.pair_frequency, {similarity} AS similarity, k.word IS NOT NULL AS is_correct_known
       FROM pairs p LEFT JOIN known k ON k.word = p.correct {join}),
fullt AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS full_transcription
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
audit AS (
  SELECT o.conv_id, o.turn, o.pos, o.wrong, o.correct, ps.pair_frequency, ps.similarity, ps.is_correct_known,
         contains(lower(coalesce(f.full_transcription, '')), o.correct) AS appears_in_full_transcription
  FROM occ o JOIN ps ON ps.wrong = o.wrong AND ps.correct = o.correct
  LEFT JOIN fullt f ON f.conv_id = o.conv_id),
flags AS (
  SELECT *, (pair_frequency < 2 AND similarity < 0.7 AND NOT is_correct_known
             AND NOT appears_in_full_transcription) AS flagged FROM audit),
per_row AS (
  SELECT conv_id, turn, count(*) AS n_corrections, sum(flagged::BIGINT) AS n_flagged,
         list({{'wrong': wrong, 'correct': correct}} ORDER BY pos) FILTER (WHERE NOT flagged) AS approved
  FROM flags GROUP BY conv_id, turn),
rows AS (
  SELECT c.conv_id, c.turn, c.role, c.text, coalesce(r.n_corrections, 0) AS n_corrections,
         coalesce(r.n_flagged, 0) AS n_flagged, coalesce(r.approved, []) AS approved,
         CASE WHEN coalesce(r.n_flagged, 0) / greatest(1, coalesce(r.n_corrections, 0)) > 0.5
              THEN 'REMOVE' ELSE 'KEEP' END AS verdict
  FROM conversations c LEFT JOIN per_row r ON r.conv_id = c.conv_id AND r.turn = c.turn),
applied AS (
  SELECT *, list_reduce(approved, lambda acc, c: array_to_string(list_transform(
             regexp_extract_all(acc, '{WORD_RE}|[^\p{{L}}\p{{N}}_]+'),
             lambda t: CASE WHEN lower(t) = c.wrong THEN c.correct ELSE t END), ''), text) AS new_text
  FROM rows)
"""


_AUDIT = _audit(edit_similarity_sql("p.wrong", "p.correct"))
_AUDIT_SEQUENCE = _audit("s.similarity", _SEQUENCE, "JOIN sequence s ON s.wrong = p.wrong AND s.correct = p.correct")

ORACLES = {
    "curate_nonword": rf"""
        WITH conv AS (SELECT CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS rec, conv_id * 1000 + turn AS ord, text,
                             regexp_extract_all(lower(text), '{WORD_RE}') AS w FROM conversations),
        p AS (SELECT rec, w[i] AS a, w[i + 1] AS b FROM (SELECT rec, w, unnest(range(1, len(w))) AS i FROM conv) WHERE (i - 1) % 7 = 0),
        occ AS (SELECT DISTINCT rec, unnest([a || ' ' || b, a || '-' || b, a || chr(39) || b, right(a, 2) || '. ' || left(b, 2),
                                             right(a, 1) || ' ' || b || ' ', a || ', ', ' ', '--']) AS correct FROM p),
        t AS (SELECT rec, lower(string_agg(text, ' ' ORDER BY ord)) AS t FROM conv GROUP BY rec)
        SELECT occ.rec, correct, contains(t, correct) AS appears FROM occ JOIN t ON t.rec = occ.rec WHERE occ.rec IS NOT NULL""",
    "parse_corrections_forms": rf"""
        WITH f AS (SELECT conv_id, turn, (conv_id + turn) % 8 AS k,
                          coalesce(nullif(regexp_extract(text, '{WORD_RE}'), ''), 'x') AS w FROM conversations)
        SELECT conv_id, turn, CASE WHEN k <= 2 THEN 1 WHEN k <= 5 THEN -1 ELSE 0 END::BIGINT AS n,
               CASE WHEN k = 1 THEN w || 'A' || chr(160) || 'A' WHEN k IN (0, 2) THEN w END AS wrong,
               CASE WHEN k = 1 THEN 'it' || chr(39) || 's' WHEN k IN (0, 2) THEN 'c' END AS correct FROM f""",
    "word_frequency": "WITH " + _BASE + " SELECT word, freq FROM wf",
    "known_words": "WITH " + _BASE + " SELECT word, freq FROM wf WHERE freq >= 3",
    "correction_pair_frequency": "WITH " + _BASE + " SELECT wrong, correct, pair_frequency FROM pairs",
    "parse_corrections": "WITH " + _BASE + """
        SELECT conv_id, turn, pos - 1 AS pos, c.wrong AS wrong, c.correct AS correct
        FROM (SELECT conv_id, turn, unnest(cs) AS c, generate_subscripts(cs, 1) AS pos FROM ch)""",
    "full_transcripts": """
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS full_transcription
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id""",
    "pair_similarity_edit": "WITH " + _BASE + f"""
        SELECT wrong, correct, round({edit_similarity_sql('wrong', 'correct')}, 6) AS similarity FROM pairs""",
    "pair_similarity_seq": "WITH RECURSIVE " + _BASE + _SEQUENCE + " SELECT wrong, correct, round(similarity, 6) AS similarity FROM sequence",
    "curate_transcripts_sequence": "WITH RECURSIVE " + _AUDIT_SEQUENCE + """
        SELECT conv_id, turn, role, new_text AS text FROM applied WHERE verdict = 'KEEP'""",
    "correction_audit": "WITH " + _AUDIT + """
        SELECT conv_id, turn, pos, wrong, correct, pair_frequency, round(similarity, 6) AS similarity,
               is_correct_known, appears_in_full_transcription, flagged FROM flags""",
    "correction_verdict": "WITH " + _AUDIT + " SELECT conv_id, turn, n_corrections, n_flagged, verdict FROM rows",
    "apply_corrections": "WITH " + _AUDIT + " SELECT conv_id, turn, new_text AS text FROM applied",
    "curate_transcripts": "WITH " + _AUDIT + """
        SELECT conv_id, turn, role, new_text AS text FROM applied WHERE verdict = 'KEEP'""",
}

QUERIES = {
    "curate_nonword": curate_nonword,
    "parse_corrections_forms": parse_corrections_forms,
    "word_frequency": word_frequency,
    "known_words": known_words,
    "correction_pair_frequency": correction_pair_frequency,
    "parse_corrections": parse_corrections_q,
    "full_transcripts": full_transcripts,
    "pair_similarity_seq": pair_similarity_seq,
    "pair_similarity_edit": pair_similarity_edit,
    "correction_audit": correction_audit,
    "correction_verdict": correction_verdict,
    "apply_corrections": apply_corrections,
    "curate_transcripts": curate_transcripts,
    "curate_transcripts_sequence": curate_transcripts_sequence,
}
