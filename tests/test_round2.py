"""Faults found by review: literal forms, column binding by name, resume safety, session settings."""

import ast
import os

import pytest
from pyspark.sql import functions as F

from asrprep.functions.corrections import parse_corrections
from asrprep.operators import curation
from asrprep.session import get_spark
from asrprep.sources import io as aio
from asrprep.streaming import prepare as prep

FORMS = [
    None, "", " \t\n", " ", "[]", " [ ] ", "[{'wrong': 'a', 'correct': 'b'}]",
    "[{'wrong': 'a', 'correct': 'b'}, {\"wrong\": \"it's\", 'correct': 'x,y'}]\n", "[{'wrong': 'a', 'correct': 'b'},]",
    r"[{'wrong': 'caf\xe9', 'correct': 'a\xa0b'}]", r"[{'wrong': '\101', 'correct': '\v\né'}]", r"[{'wrong': 'a\'b', 'correct': '\\'}]",
    "[{'wrong': 'a', 'correct': 'b'}] garbage", "[{'wrong': 'a', 'correct': 'b'}] x]", "{'wrong': 'a', 'correct': 'b'}",
    "[{'wrong': 'a', 'correct': 5}]", "[{'wrong': 'a', 'correct': {'x': 'y'}}]", "[{'wrong': 'a'}]", "[{'wrong': 'a', 'correct': None}]",
    "[{'correct': 'b', 'wrong': 'a'}]", "[{'wrong': 'a', 'correct': 'b', 'more': 1}]", "({'wrong': 'a', 'correct': 'b'},)",
    "[{'wrong': 'a' 'c', 'correct': 'b'}]", "[\x01]", "[,]", "[{'wrong': 'a', 'correct': 'b'} {'wrong': 'a', 'correct': 'b'}]", "[", "nan",
    "[{'wrong': 'a', 'correct': 'b'},, {'wrong': 'a', 'correct': 'b'}]", "[{'wrong': '', 'correct': 'tab\tin'}]",
]


def by_python(s):
    if s is None or not s.strip():
        return []
    try:
        v = ast.literal_eval(s)
    except (ValueError, SyntaxError):
        return None
    if not isinstance(v, (list, tuple)):
        return None
    ok = all(isinstance(x, dict) and isinstance(x.get("wrong"), str) and isinstance(x.get("correct"), str) for x in v)
    return [(x["wrong"], x["correct"]) for x in v] if ok else None


def test_literal_forms(spark):
    df = spark.createDataFrame(list(enumerate(FORMS)), "i int, raw string")
    got = {r["i"]: r["c"] for r in df.select("i", parse_corrections("raw").alias("c")).collect()}
    for i, s in enumerate(FORMS):
        assert (None if got[i] is None else [tuple(x) for x in got[i]]) == by_python(s), s


def test_many_records(spark):
    raw = "[" + ", ".join("{'wrong': 'w%d', 'correct': 'c%d'}" % (i, i) for i in range(20_000)) + "]"
    row = spark.createDataFrame([(raw,)], "raw string").select(F.size(parse_corrections("raw")).alias("n")).collect()[0]
    assert row["n"] == 20_000


def test_csv_binds_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m.csv")
    with open(path, "w") as f:
        f.write('transcription,extra,id,new_audio_url\n"a, ""b""\nc",x,7,u\nNA,,x8,\n')
    df = aio.read_csv(spark, path, "id long, new_audio_url string, transcription string", na_tokens=["NA"])
    assert df.columns == ["transcription", "extra", "id", "new_audio_url"]
    assert [tuple(r) for r in df.collect()] == [('a, "b"\nc', "x", 7, "u"), (None, None, None, None)]
    with pytest.raises(ValueError, match="no column nope"):
        aio.read_csv(spark, path, "nope string")


def test_path_exists_takes_uris(spark, tmp_dir):
    assert aio.path_exists(spark, f"file://{tmp_dir}") and not aio.path_exists(spark, f"file://{tmp_dir}/none")


def test_unreadable_output_fails_the_job(spark, tmp_dir):
    manifest = spark.createDataFrame([(i, f"t{i}") for i in range(8)], "id long, transcription string")
    prep.prepare_batch(spark, manifest, tmp_dir)
    run = [d for d in os.listdir(f"{tmp_dir}/good") if d.startswith("run=")][0]
    with open(f"{tmp_dir}/good/{run}/part-broken.parquet", "w") as f:
        f.write("garbage")
    with pytest.raises(Exception):
        prep.prepare_batch(spark, manifest, tmp_dir)


def test_ledger_objects_are_bounded(spark, tmp_dir):
    ids = spark.range(0, 1000, 1, 2).withColumnRenamed("id", "id")
    aio.write_ledger_json(ids, f"{tmp_dir}/ledger", ids_per_object=64)
    sizes = [len(r["processed_ids"]) for r in spark.read.json(f"{tmp_dir}/ledger").collect()]
    assert max(sizes) <= 64 and sum(sizes) == 1000
    assert aio.read_ledger_json(spark, f"{tmp_dir}/ledger").count() == 1000


def test_running_session_keeps_its_settings(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxBytesPerBatch")}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        get_spark()
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before["spark.sql.session.timeZone"])


NONWORD = ["re-run", "don't", "of the", "end start", "-", "x, y", "a-b-c", "the end st", " ", "t's", "'s ok", "abc\n", "z z", "run re", "..", "nd. s"]


def test_nonword_containment_equals_plain_python(spark):
    texts = ["We re-run it, don't we? Of the end", "start. x, y a-b-c", None, "", "it's ok..", "--", "abc"]
    chunks = spark.createDataFrame(
        [(i, "A", float(i), t) for i, t in enumerate(texts)] + [(100, "B", 1.0, "nothing here")],
        "row_id long, audio_id string, order double, transcription string")
    occ = spark.createDataFrame([(a, c) for a in "AB" for c in NONWORD + [c.upper().lower() for c in NONWORD]],
                                "audio_id string, correct string")
    full = {"A": " ".join(t for t in texts if t is not None).lower(), "B": "nothing here"}
    got = {(r["audio_id"], r["correct"]): r["appears"] for r in curation.appears_in_transcript(
        chunks, occ, tie_cols=["row_id"]).collect()}
    assert got == {(a, c): c in full[a] for a in "AB" for c in NONWORD}


def test_nonword_containment_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(curation, "STRETCH", 3)
    texts = ["Ab c", "", "", "d-e", None, "'", "", "f g.", "x", "", "", "", "", "h i", "j ΟΔΟΣ", "k", "l,m"]
    chunks = spark.createDataFrame([(i, "A", None if i > 14 else float(i), t) for i, t in enumerate(texts)],
                                   "row_id long, audio_id string, order double, transcription string").repartition(3)
    full = " ".join(t for t in texts if t is not None).lower()
    parts = {full[i:j] for i in range(len(full)) for j in range(i + 1, len(full) + 1)}
    asked = sorted(p for p in parts | {p + "!" for p in parts} | {" " + p for p in parts} if not p.isalnum())
    occ = spark.createDataFrame([("A", c) for c in asked], "audio_id string, correct string")
    got = {r["correct"]: r["appears"] for r in curation.appears_in_transcript(chunks, occ, tie_cols=["row_id"]).collect()}
    assert got == {c: c in full for c in asked}
    other = spark.createDataFrame([("A", "b c")], "audio_id string, correct string")
    rows = curation._stretches(chunks, other, "audio_id", "transcription", "order", ["row_id"], True).collect()
    assert len(rows) == 6 and max(len(r["_t"]) for r in rows) < len(full) / 2  # no row holds the recording


def _loader(location):
    if location == "fails":
        raise OSError("gone")
    return location.encode()


def _featurise(data):
    from asrprep.operators.preparation import Reject
    if data == b"odd":
        raise Reject("audio_undecodable")
    return [[float(b) for b in data]], len(data) / 10


def _manifest_rows(spark, ids):
    where = ["abc", "fails", "", "odd", "abcd", "x", "abc"]
    text = ["one two", "one", "one", "one", " ", "?", "two"]
    return spark.createDataFrame([(i, where[i % 7], text[i % 7]) for i in ids], "id long, new_audio_url string, transcription string")


OUTCOMES = {0: None, 1: "load_failed", 2: "audio_missing", 3: "audio_undecodable", 4: "text_blank", 5: "tokenize_error", 6: None}


def test_preparation_job_resumes(spark, tmp_dir):
    from asrprep.operators import labels, preparation
    vocab = labels.build_vocab(spark.createDataFrame([("one two two",)], "transcription string"))
    out = f"{tmp_dir}/features"
    args = (_loader, _featurise, vocab)
    preparation.prepare_features_batch(spark, _manifest_rows(spark, range(7)), out, "a", *args, delay=0)
    got = {r["id"]: r for r in spark.read.parquet(out).collect()}
    assert {i: r["reject_reason"] for i, r in got.items()} == OUTCOMES
    assert got[0]["labels"] == [1, 5, 4, 2] and got[0]["input_features"] == [[97.0, 98.0, 99.0]] and got[0]["input_length"] == 0.3
    assert got[1]["labels"] is None and got[1]["input_features"] is None
    preparation.prepare_features_batch(spark, _manifest_rows(spark, range(14)), out, "b", *args, delay=0)
    done = [r["id"] for r in preparation.prepared(spark, out).collect()]
    assert sorted(done) == [0, 6, 7, 13]


def test_preparation_stream_skips_ids_done_and_replays(spark, tmp_dir):
    from asrprep.operators import labels, preparation
    vocab = labels.build_vocab(spark.createDataFrame([("one two two",)], "transcription string"))
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/features"
    rows = _manifest_rows(spark, range(7))
    for checkpoint in ("c1", "c2"):  # a lost checkpoint replays every file: still one row per id
        rows.coalesce(1).write.mode("append").parquet(src)
        preparation.prepare_features_stream(spark, src, rows.schema, out, f"{tmp_dir}/{checkpoint}", _loader, _featurise, vocab, delay=0)
        assert sorted(r["id"] for r in preparation.prepared(spark, out).collect()) == [0, 6]


@pytest.mark.parametrize("form", [
    lambda v: [f"u{x}" for x in v], lambda v: {x: f"u{x}" for x in v}, lambda v: {"signedURLs": [f"u{x}" for x in v]},
    lambda v: [{"signedURL": f"u{x}", "path": x} for x in reversed(v)], lambda v: [{"signedURL": f"u{x}"} for x in v],
    lambda v: {"signedURLs": [{"signedURL": f"u{x}", "path": x} for x in v]}])
def test_signer_answer_forms(spark, form):
    from asrprep.operators.enrich import enrich
    rows = spark.range(0, 250, 1, 1).selectExpr("id", "cast(id as string) as path")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "30")
    try:
        got = enrich(rows, "id", "path", form, batch_size=100, backoff=None).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r["result"] == f"u{r['id']}" and r["error"] is None for r in got) and len(got) == 250


def test_jsonl_sink(spark, tmp_dir):
    rows = spark.createDataFrame([(1, ["a", "b"], None), (2, [], "x\ny")], "id long, urls array<string>, note string")
    aio.write_jsonl(rows, f"{tmp_dir}/side")
    back = spark.read.schema(rows.schema).json(f"{tmp_dir}/side")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
