"""Ledger in buckets with filters and commit records; the preparation job's commit."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from asrprep.operators import ledger as led, preparation
from asrprep.operators.labels import build_vocab
from asrprep.operators.manifest import select_backlog


def ids(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


def listed(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("filter_bits", [1 << 20, 64])
def test_batches_against_a_set(spark, tmp_dir, filter_bits):
    """Also with filters so full that they know every id: more is read, the answer is the same."""
    book, done, rnd = led.Ledger(spark, tmp_dir + "/l", LongType(), buckets=8, filter_bits=filter_bits), set(), random.Random(1)
    for k in range(5):
        batch = [rnd.randrange(400) for _ in range(150)]
        rows = ids(spark, [*batch, None])
        assert listed(book.seen(rows)) == sorted(set(batch) & done)
        fresh = book.unseen(rows)
        assert sorted((r["id"] for r in fresh.collect()), key=str) == sorted([v for v in batch if v not in done] + [None], key=str)
        book.add(fresh, f"r{k}")
        assert not done & set(batch) or set(listed(book.seen(rows))) == done & set(batch)  # not committed: not seen
        book.commit(f"r{k}")
        book.commit(f"r{k}")
        done |= set(batch)
        if k == 2:
            book.compact()
            assert listed(book.ids()) == sorted(done) and {r["run"][:4] for r in book.ids().collect()} == {"base"}
    assert listed(book.ids()) == sorted(done) and book.runs() == [f"r{k}" for k in range(5)]


def test_only_matching_buckets_are_read(spark, tmp_dir):
    book = led.Ledger(spark, tmp_dir, StringType(), buckets=16)
    book.add(ids(spark, [f"a{i}" for i in range(500)], "string"), "one")
    book.commit("one")
    read = []
    plain, book.ids = book.ids, lambda b=None: (read.append(b), plain(b))[1]
    assert listed(book.seen(ids(spark, ["a7", "b1", "b2"], "string"))) == ["a7"]
    assert listed(book.seen(ids(spark, ["b1", "b2"], "string"))) == []
    assert [len(b) for b in read] == [1]


def test_ledger_side_is_not_shuffled(spark, tmp_dir):
    book = led.Ledger(spark, tmp_dir, LongType(), buckets=4)
    book.add(ids(spark, range(300)), "one")
    book.commit("one")
    plan = book.seen(ids(spark, range(290, 310)))._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("LeftSemi"):]
    assert "FileScan parquet" in scan and "BroadcastExchange" in scan and "Exchange hashpartitioning" not in scan.split("FileScan")[0]


def test_cost_of_a_batch_does_not_grow(spark, tmp_dir):
    """After many batches a batch of new ids reads no id file and the same filter bytes as before."""
    book = led.Ledger(spark, tmp_dir, LongType(), buckets=4, filter_bits=1 << 12)
    sizes = []
    for k in range(6):
        book.add(book.unseen(ids(spark, range(100 * k, 100 * k + 50))), f"r{k}")
        book.commit(f"r{k}")
        newest = sorted(glob.glob(f"{tmp_dir}/filters/version=*"))[-1]
        sizes.append(book._filters().agg(F.sum(F.length("bits"))).collect()[0][0])
        assert os.path.exists(f"{newest}/_SUCCESS")
    assert len(set(sizes)) == 1


def loader(location):
    if location == "bad":
        raise OSError("gone")
    return location.encode()


def featurise(data):
    return [[float(len(data))]], 1.0


@pytest.fixture(scope="module")
def vocab(spark):
    words = spark.createDataFrame([("one two three",)], "transcription string")
    return build_vocab(words, "transcription")


def manifest_rows(spark, values):
    return spark.createDataFrame([(i, "bad" if i % 5 == 4 else f"x{i}", "one two") for i in values],
                                 "id long, new_audio_url string, transcription string")


@pytest.mark.parametrize("point", ["add", "commit"])
def test_killed_run_is_invisible_and_its_repetition_replaces_it(spark, tmp_dir, vocab, monkeypatch, point):
    out = tmp_dir + "/out"

    def go(values, run):
        preparation.prepare_features_batch(spark, manifest_rows(spark, values), out, run, loader, featurise, vocab, tries=1)

    go(range(5), "a")
    before = sorted(map(str, preparation.prepared(spark, out, None).collect()))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(led.Ledger, point, die)
        with pytest.raises(KeyboardInterrupt):
            go(range(12), "b")
    assert sorted(map(str, preparation.prepared(spark, out, None).collect())) == before  # neither good nor rejected rows
    go(range(10), "b")
    assert listed(preparation.prepared(spark, out)) == [0, 1, 2, 3, 5, 6, 7, 8]
    assert [(r["id"], r["run"]) for r in preparation.prepared(spark, out, "rejected").orderBy("run", "id").collect()] == [(4, "a"), (4, "b"), (9, "b")]
    rows = preparation.prepared(spark, out, None).count()
    go(range(100), "b")  # committed: not run again
    assert preparation.prepared(spark, out, None).count() == rows


def test_backlog_takes_a_ledger(spark, tmp_dir):
    book = led.Ledger(spark, tmp_dir, LongType())
    rows = manifest_rows(spark, range(20))
    assert select_backlog(rows, book).count() == 20
    book.add(ids(spark, [0, 1, 5]), "one")
    book.commit("one")
    assert listed(select_backlog(rows, book, sample_size=4)) == [2, 3, 4, 6]
