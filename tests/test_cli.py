"""Command-line jobs end to end on small CSV inputs."""

import json
import os

import pandas as pd

from asrprep import cli
from test_curation import EXPECTED, GOLDEN


def _csv(path, rows, cols):
    pd.DataFrame(rows, columns=cols).to_csv(path, index=False)
    return path


def test_curate_job(spark, tmp_dir):
    src = _csv(os.path.join(tmp_dir, "in.csv"), [r[1:] for r in GOLDEN], ["audio_id", "order", "transcription", "corrections"])
    out = os.path.join(tmp_dir, "out")
    cli.main(["curate", src, out, "--audit-out", os.path.join(tmp_dir, "audit")])
    got = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(out).collect()
    kept_texts = sorted((r.transcription or "") for r in got)
    expected = sorted((t or "") for v, _, _, t in EXPECTED.values() if v == "KEEP")
    assert kept_texts == expected
    assert spark.read.parquet(os.path.join(tmp_dir, "audit")).count() == 18  # corrections in the golden rows


def test_url_jobs(spark, tmp_dir):
    urls = ["https://h/storage/v1/object/sign/audios/processed/a/b.mp3?token=t", "https://h/other/c.mp3"]
    src = _csv(os.path.join(tmp_dir, "urls.csv"), [(u,) for u in urls], ["audio_url"])
    out, failed = os.path.join(tmp_dir, "updated"), os.path.join(tmp_dir, "failed")
    cli.main(["refresh-urls", src, "--output", out, "--failed", failed])
    got = spark.read.option("header", "true").csv(out).collect()
    assert sorted(r.new_audio_url.split("?")[0] for r in got) == [
        "https://storage.example/sign/processed//other/c.mp3", "https://storage.example/sign/processed/a/b.mp3"]
    lst = [(f"http://h/p/f{i}.mp3?q=1",) for i in range(10)] + [("http://h/p/f3.mp3?q=1",)] * 2
    src2 = _csv(os.path.join(tmp_dir, "list.csv"), lst, ["PresignedURL"])
    cli.main(["split-urls", src2, "--out", os.path.join(tmp_dir, "split")])
    s = spark.read.parquet(os.path.join(tmp_dir, "split")).collect()
    assert sum(r.split == "train" for r in s) == 8 and all(r.file_name.startswith("f") for r in s)


def test_prepare_and_wer_jobs(spark, tmp_dir, capsys):
    rows = [(i, f"u{i}", f" text {i} ") for i in range(6)] + [(6, "u6", None), (7, "u7", "  ")]
    src = _csv(os.path.join(tmp_dir, "manifest.csv"), rows, ["id", "new_audio_url", "transcription"])
    ledger = os.path.join(tmp_dir, "checkpoint.json")
    with open(ledger, "w") as fh:
        json.dump({"processed_ids": [0, 1]}, fh)
    out = os.path.join(tmp_dir, "prepared")
    cli.main(["prepare", "--input-csv", src, "--out", out, "--ledger-json", ledger])
    counters = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counters == {"rows": 5, "good": 4, "text_blank": 1}
    pairs = os.path.join(tmp_dir, "pairs")
    spark.createDataFrame([("a b c", "a x c"), ("d e", "d e")], "ref string, hyp string").write.parquet(pairs)
    cli.main(["wer", pairs])
    w = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert w["edits"] == 1 and w["ref_words"] == 5 and abs(w["wer"] - 20.0) < 1e-9
