"""Quality rules: a threshold table compiled into one Spark projection.

Every rule bounds one ratio of a document. ``metrics`` computes all ratios of a text from built-in
functions (no user functions, no shuffle), ``judge`` turns the table into one boolean per rule and
the verdict. The thresholds are the published web-corpus heuristics (word counts, symbol-to-word
ratio, stop words, duplicate lines, duplicate 5-word windows), not fitted to any data.

Defined cases: a null text counts as empty (no words, rejected); repeated rows are judged alike;
an empty table gives an empty table; columns of the input whose names clash with the results are
replaced by the results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asrprep.llm.exprs import count_chars, let, text_or_empty, without_ws, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "auf", "für", "sich", "dem",
    "le", "la", "les", "de", "et", "des", "un", "une", "que", "est", "pour", "dans", "qui", "du", "sur", "pas",
    "el", "los", "y", "las", "del", "se", "por", "con", "una", "para", "al", "lo", "su", "no",
]


@dataclass(frozen=True)
class Rule:
    """Keep a document when ``low <= metric <= high`` (a missing bound does not bind)."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


RULES = [
    Rule("enough_words", "n_words", low=MIN_WORDS),
    Rule("mean_word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols_to_words", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.05),
    Rule("exclamations_to_words", "exclamation_ratio", high=0.3),
    Rule("upper_case_letters", "upper_ratio", high=0.3),
    Rule("duplicate_lines", "dup_line_ratio", high=0.35),
    Rule("duplicate_windows", "repeat_ratio", high=MAX_REPEAT_PCT / 100),
]


def n_repeat_words(w: Column, window: int = WINDOW) -> Column:
    """Words lying in windows of ``window`` words that occur twice or more, each word once.

    Window hashes first tell whether anything repeats (equal windows have equal hashes, so "no
    repeated hash" is exact); only then the windows themselves are sorted next to their equals.
    Both ways take n log n steps in the length of the text.
    """
    def hashes(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - window),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    def exact(w):
        windows = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.struct(F.array_join(F.slice(w, i + 1, window), " ").alias("g"), i.alias("p"))))
        twice = let(windows, lambda s: F.filter(s, lambda x, i: (
            (i > 0) & F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False)))
            | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))))
        starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))),
            F.lit(0), lambda acc, x: acc + x))

    repeated = let(F.transform(w, lambda x: F.xxhash64(x)),
                   lambda h: let(hashes(h), lambda g: F.size(F.array_distinct(g)) < F.size(g)))
    return (F.when(F.size(w) <= window, F.lit(0))
            .when(repeated, let(w, exact)).otherwise(F.lit(0))).cast("long")


def metrics(text: Column) -> Column:
    """A struct of the counts of one text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without_ws(x)) > 0)
    bare = F.translate(F.lower(text), ".,;:!?()\"'" + SYMBOLS, "")
    return F.struct(
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), n_repeat_words(w).alias("rep"))).alias("w"),
        F.length(without_ws(text)).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        count_chars(text, "!").cast("long").alias("n_exclamations"),
        count_chars(text, UPPER).cast("long").alias("n_upper"),
        F.size(F.filter(words(bare), lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop"),
    )


def rates(m: Column) -> dict[str, Column]:
    """Counts and ratios by name, from a ``metrics`` struct."""
    def ratio(a: Column, b: Column) -> Column:
        return a / F.greatest(b, F.lit(1))

    n, lines, chars = m["w"]["n"], m["l"]["n"], m["word_chars"]
    return {
        "n_words": n, "word_chars": chars, "n_symbols": m["n_symbols"], "n_dup_lines": m["l"]["dup"],
        "n_repeat_words": m["w"]["rep"], "n_lines": lines, "n_stop_words": m["n_stop"],
        "mean_word_chars": ratio(chars, n), "symbol_ratio": ratio(m["n_symbols"], n),
        "stop_word_ratio": ratio(m["n_stop"], n), "exclamation_ratio": ratio(m["n_exclamations"], n),
        "upper_ratio": ratio(m["n_upper"], chars), "dup_line_ratio": ratio(m["l"]["dup"], lines),
        "repeat_ratio": ratio(m["w"]["rep"], n),
    }


def base_failed(v: dict[str, Column]) -> Column:
    return (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > MAX_REPEAT_PCT * v["n_words"])


def broken(r: Rule, v: dict[str, Column]) -> Column:
    bad = F.lit(False)
    if r.low is not None:
        bad = bad | (v[r.metric] < r.low)
    if r.high is not None:
        bad = bad | (v[r.metric] > r.high)
    return bad


def judge(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with the counts, ratios, ``base_failed``, ``failed_rules`` and ``kept`` of every row."""
    v = rates(F.col("_m"))
    names = [*v, "base_failed", "failed_rules", "kept"]
    own = [c for c in docs.columns if c not in names and c != "_m"]
    rated = docs.select(*own, metrics(text_or_empty(text_col)).alias("_m")).select(*own, *[c.alias(k) for k, c in v.items()])
    v = {k: F.col(k) for k in v}
    return (rated.withColumn("base_failed", base_failed(v))
            .withColumn("failed_rules", F.array_compact(F.array(*[F.when(broken(r, v), F.lit(r.name)) for r in rules])))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def verdict(text: Column, rules: list[Rule] = RULES) -> Column:
    """Whether a text passes, as one expression that computes the counts once, so that a filter on
    it, wherever the optimizer puts it, costs one pass over the text."""
    def passes(m):
        v = rates(m)
        bad = base_failed(v)
        for r in rules:
            bad = bad | broken(r, v)
        return ~bad

    return let(metrics(text), passes)


def keep_good(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return docs.where(verdict(text_or_empty(text_col), rules))
