"""Randomised differential test of the text expressions against Python's own definitions."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asrprep.functions.text import clean_transcription, normalize_for_scoring, scoring_words, strip, words

ALPHABET = (
    [chr(c) for c in range(0x20, 0x7F)]
    + [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    + ["\t", "\n", "\r", "\x0b", "\x0c", "\xa0", " ", "　", " ", "«", "»", "¿", "¡", "–", "—", "…", "€",
       "́", "ß", "ñ", "ç", "ø", "²", "½"]
    + [chr(c) for c in list(range(0x391, 0x3CA)) + list(range(0x410, 0x450))]  # Greek, Cyrillic
    + ["̈", "̧", "’", "“", "”", "•", "٠", "١", "Ⅰ"]
)
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=40)


def py_norm(s):
    s = s.lower()
    s = re.sub(r"[<\[][^>\]]*[>\]]", "", s)
    s = re.sub(r"\(([^)]+?)\)", "", s)
    s = "".join(" " if unicodedata.category(c)[0] in "MSP" else c for c in s).lower()
    return re.sub(r"\s+", " ", s)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_text_expressions_match_python(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    rows = df.select("i", strip("t").alias("s"), words("t", lower=True).alias("w"),
                     clean_transcription("t", True, True).alias("c"), scoring_words("t").alias("sw"),
                     normalize_for_scoring("t").alias("n")).orderBy("i").collect()
    for t, r in zip(batch, rows):
        assert r.s == t.strip()
        assert r.w == re.findall(r"\b\w+\b", t.lower())
        assert r.c == re.sub(r"[^\w\s]", " ", t.strip().lower()).strip()
        assert r.sw == [w for w in re.sub(r"\s\s+", " ", t).strip().split(" ") if w]
        assert r.n == py_norm(t)
