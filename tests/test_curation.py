"""Curation: golden rows (FIXTURES F1), parsing edge cases, and a differential test against an
independent plain-Python implementation of the curation rules on driver data."""

import difflib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from asrprep.functions.corrections import parse_corrections
from asrprep.functions.similarity import edit_similarity, sequence_similarity
from asrprep.operators import curation as cur
from asrprep.plans.stand_ins import CHUNK_COLS, CHUNK_KEYS, chunks
from conftest import SF001


def lit(*pairs):
    return "[" + ", ".join("{'wrong': '%s', 'correct': '%s'}" % p for p in pairs) + "]"


GOLDEN = [
    (1, "A1", 2, "o paciente tomou dipirina ontem", lit(("dipirina", "dipirona"))),
    (2, "A1", 1, "receitei dipirona ao paciente", "[]"),
    (3, "A1", 3, "Dipirina de novo, dipirina sempre", lit(("Dipirina", "Dipirona"))),
    (4, "A2", 1, "ele usa xyz", lit(("xyz", "qwkk"))),
    (5, "A2", 2, "usa xyz e abc", lit(("xyz", "qwkk2"), ("abc", "abd"))),
    (6, "A3", 1, None, "[]"),
    (7, "A3", 2, "ação da ação", lit(("ação", "acao"), ("acao", "reação"))),
    (8, None, 1, "sem id bom", lit(("bom", "zzz"))),
    (9, "A4", 1, "um um um dois paciente", lit(("dois", "um"))),
    (10, "A5", 1, "foo bar", lit(("foo", "zz9"), ("bar", "zz8"), ("foo", "paci"))),
    (11, "A6", 1, "dipirina forte", lit(("forte", "paciente"), ("paciente", "um"), ("dipirina", "zzzz"))),
    (12, "A7", 1, "foo baz", lit(("foo", "um"), ("baz", "qq"))),
    (13, "A8", 1, "o Corração bateu, corraçãozinho não", lit(("corração", "coração"))),
]
EXPECTED = {
    1: ("KEEP", 0, 1, "o paciente tomou dipirona ontem"),
    2: ("KEEP", 0, 0, "receitei dipirona ao paciente"),
    3: ("KEEP", 0, 1, "dipirona de novo, dipirona sempre"),
    4: ("REMOVE", 1, 1, None),
    5: ("REMOVE", 2, 2, None),
    6: ("KEEP", 0, 0, None),
    7: ("REMOVE", 2, 2, None),
    8: ("REMOVE", 1, 1, None),
    9: ("KEEP", 0, 1, "um um um um paciente"),
    10: ("REMOVE", 3, 3, None),
    11: ("KEEP", 1, 3, "dipirina um"),
    12: ("KEEP", 1, 2, "um baz"),
    13: ("KEEP", 0, 1, "o coração bateu, corraçãozinho não"),
}
SCHEMA = "row_id long, audio_id string, order int, transcription string, corrections string"


@pytest.fixture(scope="module")
def golden(spark):
    df = spark.createDataFrame(GOLDEN, SCHEMA)
    return cur.curate(df, ["row_id"], metric="sequence", min_word_freq=3)


def test_known_words_and_pairs(golden):
    known = {r.word: r.freq for r in cur.known_words(golden.word_freq, 3).collect()}
    assert known == {"dipirina": 4, "paciente": 3, "um": 3}
    freq2 = [(r.wrong, r.correct, r.pair_frequency) for r in golden.pair_stats.where("pair_frequency >= 2").collect()]
    assert freq2 == [("dipirina", "dipirona", 2)]


def test_full_transcripts(spark):
    df = spark.createDataFrame(GOLDEN, SCHEMA)
    full = {r.audio_id: r.full_transcription for r in cur.full_transcripts(df, tie_cols=["row_id"]).collect()}
    assert full["A1"] == ("receitei dipirona ao paciente o paciente tomou dipirina ontem "
                          "Dipirina de novo, dipirina sempre")
    assert full["A3"] == "ação da ação"
    assert None not in full


def test_verdicts_and_texts(golden):
    rows = {r.row_id: r for r in golden.rows.collect()}
    kept = {r.row_id: r.transcription for r in golden.kept.collect()}
    for rid, (verdict, flagged, n, text) in EXPECTED.items():
        r = rows[rid]
        assert (r.verdict, r.n_flagged, r.n_corrections) == (verdict, flagged, n), rid
        if verdict == "KEEP":
            assert kept[rid] == text, rid
        else:
            assert rid not in kept


def test_audit_values(golden):
    a = {(r.row_id, r.pos): r for r in golden.audit.collect()}
    r1 = a[(1, 0)]
    assert (r1.pair_frequency, round(r1.similarity, 4), r1.is_correct_known, r1.appears_in_full_transcription,
            r1.flagged) == (2, 0.875, False, True, False)
    assert round(a[(7, 0)].similarity, 4) == 0.5 and round(a[(7, 1)].similarity, 4) == 0.4
    assert round(a[(13, 0)].similarity, 4) == 0.9333 and not a[(13, 0)].appears_in_full_transcription
    assert a[(9, 0)].is_correct_known and a[(9, 0)].appears_in_full_transcription


def test_substring_containment_across_paths(spark):
    # 'ção' appears only inside a word, 'a b' contains a space (fallback path), 'zz' nowhere
    rows = [(1, "X", 1, "uma ação boa", lit(("boa", "ção"), ("uma", "a b"), ("boa", "zz"))),
            (2, "X", 2, "a b c", "[]")]
    res = cur.curate(spark.createDataFrame(rows, SCHEMA), ["row_id"], metric="edit")
    got = {r.pos: r.appears_in_full_transcription for r in res.audit.collect()}
    assert got == {0: True, 1: True, 2: False}


@pytest.mark.parametrize("raw,expected", [
    (None, []), ("", []), ("   ", []),
    ("""[{'wrong': "d'água", 'correct': 'x'}]""", [("d'água", "x")]),
    ("""[{'wrong': 'it\\'s', 'correct': 'y'}]""", [("it's", "y")]),
    ("[{'wrong': 'a', 'correct': 'b'},]", [("a", "b")]),
    ("({'wrong': 'a', 'correct': 'b'},)", [("a", "b")]),
    ('[{"wrong": "a", "correct": "b", "extra": 1}]', [("a", "b")]),
    ("[{'wrong': 'a'}]", None),
    ("[{'wrong': None, 'correct': 'b'}]", None),
    ("__import__('os')", None),
    ("not a list", None),
])
def test_parse_corrections(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    out = df.select(parse_corrections("c").alias("p")).collect()[0].p
    if expected is None:
        assert out is None
    else:
        assert [(x.wrong, x.correct) for x in out] == expected


def test_malformed_rows_are_rejected(spark):
    rows = [(1, "A", 1, "foo bar", "[{'wrong': 'foo'}]"), (2, "A", 2, "foo", lit(("foo", "bar")))]
    res = cur.curate(spark.createDataFrame(rows, SCHEMA), ["row_id"])
    got = {r.row_id: (r.verdict, r.reject_reason) for r in res.rows.collect()}
    assert got[1] == ("REJECT", "malformed_corrections")
    assert got[2][0] == "KEEP"


def test_similarity_spot_values(spark):
    pairs = [("abcd", "bcde"), ("tide", "diet"), ("diet", "tide"), ("", ""), ("ação", "acao")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [(r.s, r.e) for r in df.select(sequence_similarity("a", "b").alias("s"), edit_similarity("a", "b").alias("e")).collect()]
    for (a, b), (s, e) in zip(pairs, got):
        assert s == pytest.approx(difflib.SequenceMatcher(None, a, b).ratio())
    assert [round(s, 4) for s, _ in got[:4]] == [0.75, 0.25, 0.5, 1.0]
    assert got[4][1] == pytest.approx(0.5)  # two code-point substitutions over four


def test_replacement_is_literal_and_whole_word(spark):
    rows = [(1, "A", 1, "a.b a+b cost $5 a.b", lit(("a.b", "x$1\\\\")))]
    res = cur.curate(spark.createDataFrame(rows, SCHEMA), ["row_id"], similarity_threshold=0.0)
    # the literal 'x$1\\' is the word x$1 followed by one backslash (as Python's literal_eval reads it)
    assert res.kept.collect()[0].transcription == "x$1\\ a+b cost $5 x$1\\"


# --- differential: independent plain-Python implementation of the rules ---------------------

def _python_curation(rows, min_pair=2, sim_th=0.7, min_wf=3):
    wf = Counter()
    for r in rows:
        if isinstance(r["text"], str):
            wf.update(re.findall(r"\b\w+\b", r["text"].lower()))
    known = {w for w, c in wf.items() if c >= min_wf}
    pairs = Counter()
    for r in rows:
        for c in r["cs"]:
            pairs[(c[0].lower(), c[1].lower())] += 1
    by_audio = {}
    for r in sorted(rows, key=lambda r: (r["order"], r["turn"])):
        by_audio.setdefault(r["audio"], []).append(r["text"])
    full = {a: " ".join(t for t in ts if t is not None) for a, ts in by_audio.items()}
    out = {}
    for r in rows:
        flagged, text = 0, r["text"]
        approved = []
        for w, c in r["cs"]:
            w, c = w.lower(), c.lower()
            bad = (pairs[(w, c)] < min_pair and difflib.SequenceMatcher(None, w, c).ratio() < sim_th
                   and c not in known and c not in full.get(r["audio"], "").lower())
            flagged += bad
            if not bad:
                approved.append((w, c))
        verdict = "REMOVE" if flagged / max(1, len(r["cs"])) > 0.5 else "KEEP"
        for w, c in approved:
            text = re.sub(r"\b%s\b" % re.escape(w), lambda m, c=c: c, text, flags=re.IGNORECASE)
        out[(r["conv_id"], r["turn"])] = (verdict, text if verdict == "KEEP" else None)
    return out


@pytest.mark.parametrize("sf_dir", [SF001, "/root/testdata/sf0.01"])
def test_differential_on_driver_data(spark, sf_dir):
    ch = chunks(spark, sf_dir).withColumn("cs", parse_corrections("corrections"))
    rows = [dict(conv_id=r.conv_id, turn=r.turn, audio=r.conv_id, order=r.turn, text=r.text,
                 cs=[(x.wrong, x.correct) for x in r.cs]) for r in ch.collect()]
    expected = _python_curation(rows)
    res = cur.curate(chunks(spark, sf_dir), CHUNK_KEYS, metric="sequence", **CHUNK_COLS)
    verdicts = {(r.conv_id, r.turn): r.verdict for r in res.rows.collect()}
    kept = {(r.conv_id, r.turn): r.text for r in res.kept.collect()}
    assert len(verdicts) == len(expected)
    for k, (v, t) in expected.items():
        assert verdicts[k] == v, k
        if v == "KEEP":
            assert kept[k] == t, k
    assert sum(v == "REMOVE" for v, _ in expected.values()) > 0


def test_similarity_udf_runs_on_distinct_pairs(spark):
    ch = chunks(spark, SF001)
    occ = cur.parse_once(ch, CHUNK_KEYS, "conv_id", "corrections", pin=False).where("not malformed")
    stats = cur.pair_statistics(occ, cur.word_frequency(ch, "text"), 3, "sequence")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    # the Python evaluation sits above the pair aggregate, i.e. once per distinct pair
    assert "BatchEvalPython" not in plan
    sim_eval = [i for i in range(len(plan)) if plan.startswith("ArrowEvalPython [_sequence_ratio", i)]
    assert len(sim_eval) == 1 and sim_eval[0] < plan.index("HashAggregate")


def test_full_transcripts_two_levels(spark):
    # more chunks than one order range, null texts and a null order, tiny ranges to force many pieces
    rows = [(i, "R", i, (None if i % 7 == 0 else f"w{i}"), "[]") for i in range(1, 60)] + [(100, "R", None, "last", "[]")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = cur.full_transcripts(df, tie_cols=["row_id"], bucket_width=5).collect()[0].full_transcription
    expected = " ".join([f"w{i}" for i in range(1, 60) if i % 7 != 0] + ["last"])
    assert got == expected


def test_pair_similarity_seq_brute_force_sf001(spark):
    import __spark_entry__ as E
    rows = E.queries()["pair_similarity_seq"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) > 10000
    for r in rows:
        assert r.similarity == round(difflib.SequenceMatcher(None, r.wrong, r.correct).ratio(), 6), (r.wrong, r.correct)
