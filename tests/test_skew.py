"""Skewed inputs: one recording, one correction pair and one URL each hold a third of the rows.
Results must equal the plain-Python model; no row is dropped or capped."""

import random

from asrprep.operators import curation as cur
from asrprep.operators import sampling
from test_curation import SCHEMA, _python_curation

WORDS = "casa casas caso acaso paz pazes mar mares sol soles luz luces dia dias noite".split()


def _rows(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        audio = "HOT" if i % 3 == 0 else f"A{i % 40}"
        text = " ".join(rnd.choices(WORDS, k=rnd.randrange(3, 12)))
        cs = []
        if i % 3 == 0:
            cs.append(("casa", "cosa"))  # the hot pair
        for _ in range(rnd.randrange(0, 3)):
            w = rnd.choice(WORDS)
            c = rnd.choice(WORDS + ["asas", "ares", "qq", "oles"])
            cs.append((w, c))
        lit = "[" + ", ".join("{'wrong': '%s', 'correct': '%s'}" % p for p in cs) + "]"
        rows.append((i, audio, i // 7, text, lit, cs))
    return rows


def test_curation_with_hot_recording_and_pair(spark):
    rows = _rows()
    df = spark.createDataFrame([r[:5] for r in rows], SCHEMA)
    res = cur.curate(df, ["row_id"], metric="sequence")
    model_in = [dict(conv_id=r[0], turn=0, audio=r[1], order=r[2], text=r[3], cs=r[5]) for r in rows]
    # the plain model orders by (order, turn); give it the row id as the tie breaker
    for m in model_in:
        m["turn"] = m["conv_id"]
    expected = _python_curation(model_in)
    got = {r.row_id: r.verdict for r in res.rows.collect()}
    kept = {r.row_id: r.transcription for r in res.kept.collect()}
    assert len(got) == len(rows)
    for (rid, _), (verdict, text) in expected.items():
        assert got[rid] == verdict, rid
        if verdict == "KEEP":
            assert kept[rid] == text, rid
    hot = res.pair_stats.where("wrong = 'casa' and correct = 'cosa'").collect()[0]
    assert hot.pair_frequency == 200


def test_split_with_hot_url(spark):
    urls = ["http://h/hot.mp3"] * 300 + [f"http://h/{i}.mp3" for i in range(600)]
    df = spark.createDataFrame(list(enumerate(urls)), "id long, url string")
    s = sampling.train_eval_split(df, "url", 0.7, 42, tie_col="id").collect()
    train = [r for r in s if r.split == "train"]
    evals = [r for r in s if r.split == "eval"]
    assert len(train) == round(0.7 * 900)
    assert not ({r.url for r in train} & {r.url for r in evals})
    hot_in_train = sum(r.url == "http://h/hot.mp3" for r in train)
    hot_in_eval = sum(r.url == "http://h/hot.mp3" for r in evals)
    assert hot_in_eval == 0 or hot_in_train == 0
    assert hot_in_train + hot_in_eval in (300, hot_in_train)
