"""Strings that occur in their group's texts: the filtered pass against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from asrprep.operators import containment, curation

ALPHABET = ["a", "b", "ab", "é", "ß", " ", "  ", "-", ", ", "'", "日", "\U0001F600", "_", "9", ". "]


def strings(rnd, n):
    return ["".join(rnd.choices(ALPHABET, k=rnd.randrange(1, 7))) for _ in range(n)]


@pytest.mark.parametrize("max_bits", [containment.MAX_BITS, 1 << 16, 1 << 10])
def test_candidates_hold_every_occurring_string(spark, max_bits):
    """Also with a filter so small that several passes are needed."""
    rnd = random.Random(max_bits)
    texts = [(rnd.choice(["x", "y", "hot", "hot"]), "".join(rnd.choices(ALPHABET, k=rnd.randrange(0, 60)))) for _ in range(80)]
    asked = sorted({(g, s) for g in ("x", "y", "hot", "none") for s in strings(rnd, 150)})
    a = spark.createDataFrame(asked, "g string, correct string")
    t = spark.createDataFrame(texts, "g string, _t string").repartition(3)
    got = {tuple(r) for r in containment.candidates(t, a, len(asked), "g", max_bits=max_bits).collect()}
    want = {(g, s) for g, s in asked if any(s in text for h, text in texts if h == g)}
    assert want and want <= got
    assert all(any(s in text for h, text in texts if h == g) for g, s in got)


def test_filter_keeps_few_strings_that_were_not_asked(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(4000)]
    texts = [(0, " ".join(rnd.choices(words, k=200))) for _ in range(40)]
    asked = sorted({(0, f"{a}-{b}") for a, b in zip(words, words[1:])} | {(0, f"{a} {b}") for a, b in zip(words, words[1:])})
    a, t = spark.createDataFrame(asked, "g long, correct string"), spark.createDataFrame(texts, "g long, _t string")
    got = {tuple(r) for r in containment.candidates(t, a, len(asked), "g").collect()}
    assert len(got - set(asked)) < 0.05 * 40 * 200


def test_hot_recording_and_long_corrections(spark):
    """One recording with most chunks; corrections across chunks, as long as several stretches, and over word parts."""
    rnd = random.Random(5)
    rows = [("hot" if i % 3 else f"r{i % 7}", i, rnd.choice([None, "", "Ab, cd.", "ef gh", "x--y", "it's. Über", "a" * 40 + " b"])) for i in range(1500)]
    full = {}
    for rec, _, text in rows:
        if text is not None:
            full.setdefault(rec, []).append(text)
    full = {k: " ".join(v).lower() for k, v in full.items()}
    asked = set()
    for rec in full:
        for _ in range(60):
            at, n = rnd.randrange(len(full[rec])), rnd.choice([1, 2, 3, 5, 9, 30, 400, 2500])
            s = full[rec][at:at + n]
            asked |= {(rec, s), (rec, s[::-1]), (rec, s + "?"), (rec, "-" + s)}
    asked |= {("absent", "a b"), (None, "a b"), ("hot", " "), ("hot", "--"), ("hot", "'"), ("hot", "#")}
    asked = sorted((a for a in asked if a[1]), key=str)
    df = spark.createDataFrame(rows, "rec string, ord long, text string").repartition(5)
    occ = spark.createDataFrame(asked, "rec string, correct string")
    got = {(r["rec"], r["correct"]): r["appears"] for r in curation.appears_in_transcript(df, occ, "rec", "text", "ord").collect()}
    assert got == {(rec, s): s in full.get(rec, "") for rec, s in asked if rec is not None}
    assert sum(got.values()) > 100


def test_no_nonword_corrections_need_no_pass_over_the_text(spark, monkeypatch):
    monkeypatch.setattr(curation, "candidates", None)
    monkeypatch.setattr(curation, "_stretches", None)
    df = spark.createDataFrame([("r", 0, "one two")], "rec string, ord long, text string")
    occ = spark.createDataFrame([("r", "one"), ("r", "tw"), ("r", "x")], "rec string, correct string")
    got = {r["correct"]: r["appears"] for r in curation.appears_in_transcript(df, occ, "rec", "text", "ord").collect()}
    assert got == {"one": True, "tw": True, "x": False}
    assert curation.appears_in_transcript(df, occ.where(F.lit(False)), "rec", "text", "ord").count() == 0
