"""Text expressions (Column -> Column): tokenising, stripping, punctuation removal, scoring normaliser.

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters Python's ``str.isspace`` / ``str.strip()`` / Unicode ``\s`` treat as
# whitespace (Java's ``trim`` strips only U+0020 and control chars, and ``\s`` is ASCII-only).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex character-class body (valid for Java regex and RE2).
WS_CLASS_BODY = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_CLASS_BODY}]"
# Python's Unicode ``\w``: letters, numbers and underscore.
WORD_CLASS_BODY = r"\p{L}\p{N}_"
WORD = f"[{WORD_CLASS_BODY}]+"
NOT_WORD = f"[^{WORD_CLASS_BODY}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text, lower: bool = False) -> Column:
    """``re.findall(r'\\b\\w+\\b', s)``: the maximal runs of word characters, as an array."""
    t = _c(text)
    if lower:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(WORD), 0)


def strip(text) -> Column:
    """``str.strip()`` with the Unicode whitespace set."""
    return F.btrim(_c(text), F.lit(WHITESPACE_CHARS))


def remove_punctuation(text) -> Column:
    """``re.sub(r'[^\\w\\s]', ' ', s).strip()``."""
    return strip(F.regexp_replace(_c(text), f"[^{WORD_CLASS_BODY}{WS_CLASS_BODY}]", " "))


def clean_transcription(text, lower_case: bool = False, remove_punct: bool = False) -> Column:
    """Transcript clean-up of the preparation job: strip, optional lower-case, optional punctuation removal.

    Returns null for null input; blank results are the empty string (the caller rejects them).
    """
    t = strip(text)
    if lower_case:
        t = F.lower(t)
    if remove_punct:
        t = remove_punctuation(t)
    return t


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def normalize_for_scoring(text, nfkc: bool = False) -> Column:
    """Basic scoring normaliser: lower-case, drop ``[..]``/``<..>`` and ``(..)`` spans, turn marks,
    symbols and punctuation into spaces, collapse whitespace runs to one space.

    ``nfkc=True`` also applies Unicode NFKC folding (ligatures, full-width forms) before the symbol
    step, through an Arrow-batched pandas UDF (Spark has no built-in for it). Text that is already
    NFKC, which is what transcripts are in practice, gives the same result without it.
    """
    t = F.lower(_c(text))
    t = F.regexp_replace(t, r"[<\[][^>\]]*[>\]]", "")
    t = F.regexp_replace(t, r"\(([^)]+?)\)", "")
    if nfkc:
        t = _nfkc(t)
    t = F.regexp_replace(t, r"[\p{M}\p{S}\p{P}]", " ")
    t = F.lower(t)
    return F.regexp_replace(t, f"{WS}+", " ")


def scoring_words(text) -> Column:
    """Word list used for error-rate scoring: runs of two or more whitespace characters become one
    space, the ends are stripped, then the text is split on single spaces; empty pieces are dropped."""
    t = strip(F.regexp_replace(_c(text), f"{WS}{WS}+", " "))
    return F.filter(F.split(t, " "), lambda w: F.length(w) > 0)


def is_blank(text) -> Column:
    return F.length(strip(text)) == 0
