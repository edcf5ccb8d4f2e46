"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asrprep.llm import (bfd_packing, bpe, exact_dedup, html_text, licenses, merkle, mixture_packing, ngram_lm, periodic_runs,
                         quality, rules, simhash, toxicity)
from asrprep.llm.exprs import crc_mod, let, table, words

# DuckDB: the texts with ASCII white space deleted
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_NORM} AS norm, length(coalesce(text, '')) AS n FROM documents),
k AS (SELECT doc_id, norm, n, max(n) OVER (PARTITION BY norm) AS longest,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
        count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND n = longest AS kept, sha256(norm) AS text_sha256 FROM k
"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in rules.STOP_WORDS)


def _op8_sql() -> str:
    checks = []
    for r in rules.RULES:
        if r.low is not None:
            checks.append(f"{r.metric} >= {r.low}")
        if r.high is not None:
            checks.append(f"{r.metric} <= {r.high}")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        list_filter(regexp_extract_all(
            regexp_replace(lower(text), '[.,;:!?()"''#*$%&|<>]', '', 'g'), '[^\x20\x09-\x0D]+'),
            lambda x: x IN ({_stop_list()})) AS stops FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
t AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS rep FROM t, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep, 0) AS n_repeat_words,
        len(ls) AS n_lines, len(stops) AS n_stop,
        length(text) - length(replace(text, '!', '')) AS n_excl,
        length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
      FROM w LEFT JOIN p ON p.doc_id = w.doc_id),
r AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
        n_stop / greatest(n_words, 1) AS stop_word_ratio, n_excl / greatest(n_words, 1) AS exclamation_ratio,
        n_upper / greatest(word_chars, 1) AS upper_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
        n_repeat_words / greatest(n_words, 1) AS repeat_ratio,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(checks)} AS kept FROM r
"""


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_packing.pack(table(spark, sf_dir, "documents"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_packing.pack(table(spark, sf_dir, "documents"))


def op4_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return quality.score(docs, model, held)


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model, held)


def op6_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) != 1)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The contract's texts of op12: where h = crc32(doc_id) is divisible by 10, the words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(w):
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda at: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
            w, F.when(i < at["a"], i).otherwise(at["a"] + (i - at["a"]) % at["p"]))), " "))

    text = F.when(h % 10 == 0, let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))))
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.withColumn("r", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("r.start").alias("start"), (-F.col("r.neg")).alias("length"),
        F.col("r.period").alias("period"), F.floor(-F.col("r.neg") * 1000 / F.col("r.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


QUERIES = {"op11_license_scan": op11_license_scan, "op12_periodic_runs": op12_periodic_runs, "op13_merkle_manifest": op13_merkle_manifest, "op6_elias_fano_lm": op6_elias_fano_lm, "op2_byte_bpe": op2_byte_bpe, "op4_quality_pu": op4_quality_pu, "op5_toxicity_cnn": op5_toxicity_cnn, "op9_html_extraction": op9_html_extraction, "op1_best_fit_packing": op1_best_fit_packing, "op3_simhash": op3_simhash, "op10_mixture_packing": op10_mixture_packing, "op7_exact_dedup": op7_exact_dedup, "op8_quality_rules": op8_quality_rules}
ORACLES = {"op11_license_scan": licenses.oracle_sql(), "op13_merkle_manifest": merkle.oracle_sql(), "op7_exact_dedup": OP7_SQL, "op8_quality_rules": _op8_sql()}
