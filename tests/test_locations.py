"""Ingest by location, and the command-line job that makes features of it."""

import base64
import io
import json
import wave

import numpy as np
import pandas as pd
import pytest

from asrprep import cli
from asrprep.operators import preparation
from asrprep.sources import locations


class Flaky:
    def __init__(self):
        self.calls = {}

    def __call__(self, location):
        n = self.calls[location] = self.calls.get(location, 0) + 1
        if location.startswith("gone"):
            raise FileNotFoundError(location)
        if location.startswith("broken") or (location.startswith("late") and n < 3):
            raise OSError("try again")
        return b"" if location.startswith("empty") else location.encode()


def test_every_location_has_a_row(spark):
    rows = [(i, f"{kind}/a{i}.wav?t=1") for i, kind in enumerate(["gone", "late", "broken", "empty", "x"] * 5)] + [(90, None), (91, " ")]
    df = spark.createDataFrame(rows, "id long, url string")
    got = {r["id"]: r for r in locations.read_locations(df, "url", Flaky, ("id",), delay=0, objects_per_task=7).collect()}
    assert len(got) == len(rows)
    want = {"gone": ("missing", 1, None), "late": ("Success", 3, 1), "broken": ("failed", 3, None), "empty": ("empty", 1, 0), "x": ("Success", 1, 1)}
    for i, url in rows:
        r = got[i]
        if url is None or not url.strip():
            assert (r["status"], r["attempts"], r["length"], r["content"]) == ("missing", 0, None, None)
            continue
        status, calls, size = want[url.split("/")[0]]
        assert (r["status"], r["attempts"], r["file_name"]) == (status, calls, f"a{i}.wav")
        assert r["length"] == (None if size is None else len(url) if size else 0)
        assert r["content"] == (None if size is None else bytearray(url.encode()) if size else bytearray())
        assert (r["error"] is None) == (status in ("Success", "empty"))
    assert locations.read_locations(df.limit(0), "url", Flaky, ("id",)).collect() == []


def test_default_loader(tmp_dir):
    with open(f"{tmp_dir}/a b", "wb") as f:
        f.write(b"xyz")
    assert locations.open_location(f"{tmp_dir}/a b") == b"xyz" == locations.open_location("data:,xyz")
    assert locations.open_location("data:x/y;base64,eHl6") == b"xyz"
    assert locations.fetch(locations.open_location, f"{tmp_dir}/none", 3, 0)[1:3] == ("missing", 1)
    assert locations.fetch(locations.open_location, "data:x/y;base64,e!", 2, 0)[1:3] == ("failed", 2)
    assert locations.fetch(locations.open_location, "ftp://h/x", 1, 0)[1] == "failed"


def wav(n, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes((np.sin(np.arange(n * channels)) * 9000).astype("<i2").tobytes())
    return "data:;base64," + base64.b64encode(out.getvalue()).decode()


def test_prepare_job_makes_features_and_labels(spark, tmp_dir, capsys):
    rows = [(1, wav(8000), "one two"), (2, "data:,", "one"), (3, wav(1600, 2), "one"), (4, "data:,junk", "two"), (5, wav(1600), " "),
            (6, f"{tmp_dir}/none", "one"), (7, wav(3200), "two two three"), (8, wav(1600), None)]
    pd.DataFrame(rows, columns=["id", "new_audio_url", "transcription"]).to_csv(f"{tmp_dir}/m.csv", index=False)
    job = ["prepare", "--audio", "--input-csv", f"{tmp_dir}/m.csv", "--out", f"{tmp_dir}/out", "--delay", "0", "--tries", "1"]
    cli.main([*job, "--run", "a", "--sample-size", "4"])
    cli.main([*job, "--run", "b"])
    first, second = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert first == {"run": "a", "ok": 1, "audio_missing": 1, "audio_undecodable": 1, "multi_channel": 1}
    assert second == {"run": "b", "ok": 1, "audio_missing": 1, "audio_undecodable": 1, "load_failed": 1, "multi_channel": 1, "text_blank": 1}
    good = {r["id"]: r for r in preparation.prepared(spark, f"{tmp_dir}/out").collect()}
    assert sorted(good) == [1, 7] and good[1]["input_length"] == pytest.approx(0.5) and len(good[7]["labels"]) == 5
    assert np.array(good[1]["input_features"]).shape == (80, 3000)
