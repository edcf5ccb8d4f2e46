"""Expressions for correction lists: parsing the stored literal and the ordered whole-word fold."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from asrprep.functions.text import WORD_CLASS_BODY, strip

CORRECTION = StructType([StructField("wrong", StringType()), StructField("correct", StringType())])
CORRECTIONS = ArrayType(CORRECTION)
_JSON_OPTS = {"allowSingleQuotes": "true"}
# one record of the usual form: both keys in order, string values without backslashes or line ends
_STRING = r"""(?:'[^'\\\n\r]*+'|"[^"\\\n\r]*+")"""
_RECORD = rf"""\{{\s*+['"]wrong['"]\s*+:\s*+{_STRING}\s*+,\s*+['"]correct['"]\s*+:\s*+{_STRING}\s*+\}}"""
_MARK = "\x01"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_list(s: str):
    """Strict parse of a Python list-of-dicts literal; never executes code. None = malformed."""
    try:
        value = ast.literal_eval(s)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if not isinstance(value, (list, tuple)):
        return None
    out = []
    for item in value:
        if not isinstance(item, dict):
            return None
        w, c = item.get("wrong"), item.get("correct")
        if not isinstance(w, str) or not isinstance(c, str):
            return None
        out.append({"wrong": w, "correct": c})
    return out


@F.pandas_udf(CORRECTIONS)
def _strict_parse_fn(raw: pd.Series) -> pd.Series:
    # rows that the JSON reader already handled arrive as null and are skipped without a Python call
    out = pd.Series([None] * len(raw), dtype="object")
    todo = raw.notna()
    if todo.any():
        out[todo] = raw[todo].map(_literal_list)
    return out


# Marked non-deterministic on purpose: it is an optimizer barrier, so filters inferred further up
# (e.g. from an explode) are not pushed below the parse and the parse is evaluated once per row.
_strict_parse = _strict_parse_fn.asNondeterministic()


def _valid(arr: Column) -> Column:
    return F.forall(arr, lambda x: x.isNotNull() & x["wrong"].isNotNull() & x["correct"].isNotNull())


def _usual_form(raw: Column) -> Column:
    """The whole text is one list of records of the usual form: with each record replaced by a mark
    and blanks removed, only marks and commas remain between the brackets."""
    rest = F.translate(F.regexp_replace(raw, _RECORD, _MARK), " \t\n\r", "")
    return F.get(F.transform(F.array(rest), lambda r: (
        F.startswith(r, F.lit("[")) & F.endswith(r, F.lit("]")) & (F.length(r) >= 2)
        & ((r == "[]") | (F.replace(F.concat(r.substr(F.lit(2), F.length(r) - 2), F.lit(",")), F.lit(_MARK + ","), F.lit("")) == "")))),
        F.lit(0)) & ~raw.contains(_MARK)


def parse_corrections(raw) -> Column:
    """Parse ``"[{'wrong': 'a', 'correct': 'b'}, ...]"`` into ``array<struct<wrong, correct>>``.

    Null, empty and blank strings (Unicode white space) give an empty list. The JVM JSON reader
    (single quotes allowed) reads texts that are wholly of the usual form, without backslashes;
    every other text goes through a strict Python literal parser, so escapes mean what they mean there.
    Result is null when the text is malformed (not a list of records with string ``wrong`` and
    ``correct``); callers turn that into a ``malformed_corrections`` reject.
    """
    raw = _c(raw)
    blank = raw.isNull() | (F.length(strip(raw)) == 0)
    js = F.when(_usual_form(raw), F.from_json(raw, CORRECTIONS, _JSON_OPTS))
    js_ok = js.isNotNull() & _valid(js)
    fallback = _strict_parse(F.when(~blank & ~js_ok, raw))
    return (F.when(blank, F.array().cast(CORRECTIONS))
            .when(js_ok, js)
            .otherwise(fallback))


def corrections_literal(arr) -> Column:
    """Inverse of :func:`parse_corrections` for word-only values: the stored literal form."""
    item = lambda c: F.concat(F.lit("{'wrong': '"), c["wrong"], F.lit("', 'correct': '"), c["correct"], F.lit("'}"))
    return F.concat(F.lit("["), F.array_join(F.transform(_c(arr), item), ", "), F.lit("]"))


def whole_word_pattern(wrong) -> Column:
    """Case-insensitive whole-word regex for the literal text ``wrong``."""
    quoted = F.replace(_c(wrong), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit(f"(?iu)(?<![{WORD_CLASS_BODY}])\\Q"), quoted, F.lit(f"\\E(?![{WORD_CLASS_BODY}])"))


def literal_replacement(correct) -> Column:
    """Escape ``\\`` and ``$`` so the replacement is inserted literally."""
    return F.replace(F.replace(_c(correct), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def apply_in_order(text, corrections) -> Column:
    """Replace each ``wrong`` (whole word, any case) by ``correct``, in list order, each step on the
    result of the previous one. Null text stays null."""
    return F.aggregate(_c(corrections), _c(text),
                       lambda acc, c: F.regexp_replace(acc, whole_word_pattern(c["wrong"]),
                                                       literal_replacement(c["correct"])))
