"""File order, the shuffle buffer over a stream, the answer journal, and distances of long pairs."""

import json
import os
import random
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from asrprep.functions.hashing import seeded_hash32
from asrprep.operators import file_order, scoring
from asrprep.operators.journal import Journal, enrich_journaled
from asrprep.streaming.shuffle import LazyShuffle

SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType())])


def write_files(spark, path, ids, files=5):
    """Files with the given ids in order, in name order."""
    size = -(-len(ids) // files)
    for k in range(files):
        part = [(i, f"n{i}") for i in ids[k * size:(k + 1) * size]]
        if part:
            target = os.path.join(path, f"part-{k:05d}.parquet")
            spark.createDataFrame(part, SCHEMA).coalesce(1).toPandas().to_parquet(target, row_group_size=7)
            os.utime(target, (1_600_000_000 + k, 1_600_000_000 + k))


@pytest.fixture()
def shuffled_ids():
    ids = list(range(137))
    random.Random(3).shuffle(ids)
    return ids


def test_positions_follow_the_files_without_an_exchange_of_rows(spark, tmp_dir, shuffled_ids):
    write_files(spark, tmp_dir, shuffled_ids)
    out = file_order.batches_in_file_order(spark.read.parquet(tmp_dir), 20, 6)
    rows = {r["id"]: (r["idx"], r["batch_id"], r["sub_batch"]) for r in out.collect()}
    assert rows == {i: (p, p // 20, p % 20 // 6) for p, i in enumerate(shuffled_ids)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Sort " not in plan
    some = file_order.with_file_index(spark.read.parquet(tmp_dir).select("id"), "at").where("id % 3 = 0").collect()
    assert {r["id"]: r["at"] for r in some} == {i: p for p, i in enumerate(shuffled_ids) if i % 3 == 0}


def test_interleave_scans_whole_rounds(spark, tmp_dir):
    for name, ids in (("a", [5, 3, 9, 1, 7]), ("b", [20, 24, 22])):
        os.makedirs(os.path.join(tmp_dir, name))
        write_files(spark, os.path.join(tmp_dir, name), ids, files=2)
    scans = {n: spark.read.parquet(os.path.join(tmp_dir, n)).select("id") for n in "ab"}
    got = sorted((r["seq"], r["split"], r["pos"], r["id"]) for r in file_order.interleave_scans(scans).collect())
    assert got == [(0, "a", 0, 5), (1, "b", 0, 20), (2, "a", 1, 3), (3, "b", 1, 24), (4, "a", 2, 9), (5, "b", 2, 22)]
    for late in (scans["a"].where("id < 5"), scans["a"].groupBy("id").count()):
        with pytest.raises(ValueError):
            file_order.with_file_index(late)
    spark.createDataFrame([], SCHEMA).write.parquet(os.path.join(tmp_dir, "empty"))
    empty = spark.read.parquet(os.path.join(tmp_dir, "empty"))
    assert file_order.with_file_index(empty).collect() == [] and file_order.file_offsets(empty)[1] == 0


def order_of(work, end=True):
    return [(r["id"], r["position"], r["out_position"]) for r in sorted(work.rows(end).collect(), key=lambda r: r["out_position"])]


def wanted_order(spark, ids, buffer, seed=42, epoch=0):
    df = spark.createDataFrame([(i,) for i in ids], "id long").select("id", seeded_hash32(seed, F.lit(epoch), "id").alias("h"))
    h = {r["id"]: r["h"] for r in df.collect()}
    due = sorted((p + (h[i] * buffer >> 32), h[i], str(i), p) for p, i in enumerate(ids))
    return [(int(i), p, k) for k, (_, _, i, p) in enumerate(due)]


@pytest.mark.parametrize("files_a_batch", [1, 2, 9])
def test_buffer_order_does_not_depend_on_micro_batches(spark, tmp_dir, shuffled_ids, files_a_batch):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    write_files(spark, src, shuffled_ids)
    work = LazyShuffle(spark, src, SCHEMA, out, "id", buffer=25, files_a_batch=files_a_batch)
    assert work.rows().collect() == [] and work.rows().columns == ["id", "name", "position", "out_position"]
    work.run(os.path.join(tmp_dir, "ckpt"))
    got = order_of(work)
    assert got == wanted_order(spark, shuffled_ids, 25)
    assert all(abs(p - q) < 25 for _, p, q in got) and [i for i, _, _ in got] != shuffled_ids
    left = order_of(work, end=False)
    assert left == got[:len(left)] and len(got) - len(left) <= 25


def test_stream_goes_on_from_the_buffer_and_replays_alike(spark, tmp_dir, shuffled_ids):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    write_files(spark, src, shuffled_ids[:80], files=2)
    work = LazyShuffle(spark, src, SCHEMA, out, "id", buffer=30)
    work.run(ckpt)
    first = order_of(work, end=False)
    size = len(shuffled_ids) - 80
    target = os.path.join(src, "part-00009.parquet")
    spark.createDataFrame([(i, "x") for i in shuffled_ids[80:]], SCHEMA).toPandas().to_parquet(target)
    work.run(ckpt)
    again = order_of(work)
    assert again == wanted_order(spark, shuffled_ids, 30) and again[:len(first)] == first
    # the last micro-batch once more, as after a crash before its commit
    batch = spark.read.parquet(target).select("*", F.lit(0).alias("_time"), F.lit("p").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    work._take(batch, 2)
    assert order_of(work) == again and size == batch.count()


def test_buffer_of_one_keeps_the_order_and_bad_sizes_fail(spark, tmp_dir, shuffled_ids):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    write_files(spark, src, shuffled_ids[:12], files=3)
    work = LazyShuffle(spark, src, SCHEMA, os.path.join(tmp_dir, "out"), "id", buffer=1)
    work.run(os.path.join(tmp_dir, "ckpt"))
    assert [i for i, _, _ in order_of(work, end=False)] == shuffled_ids[:12]
    with pytest.raises(ValueError):
        LazyShuffle(spark, src, SCHEMA, tmp_dir, "id", buffer=0)


class CountingClient:
    """Writes down what it is asked; refuses some values, fails for others."""

    def __init__(self, log, refuse=(), fail=()):
        self.log, self.refuse, self.fail = log, set(refuse), set(fail)

    def __call__(self, values):
        with open(os.path.join(self.log, f"{os.getpid()}-{time.monotonic_ns()}"), "w") as f:
            json.dump(values, f)
        if self.fail & set(values):
            raise OSError("down")
        return {v: v.upper() for v in values if v not in self.refuse}


def asked(log):
    return sorted(v for f in os.listdir(log) for v in json.load(open(os.path.join(log, f))))


def test_second_run_asks_only_for_what_lacks_an_answer(spark, tmp_dir):
    log, log2 = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "log2")
    os.makedirs(log), os.makedirs(log2)
    rows = spark.createDataFrame([(i, f"v{i % 20}", i, "old") for i in range(40)] + [(None, "x", 7, "old"), (99, None, 8, "old")],
                                 "id long, v string, n long, error string")
    book = Journal(spark, os.path.join(tmp_dir, "book"))
    assert book.answers().collect() == []
    book.ask(rows.where("id < 30"), "v", "v", CountingClient(log, refuse=["v3"], fail=["v7"]), "1", batch_size=4, max_retries=2, backoff=None,
             partitions=2)
    kept = {r["key"]: r["answer"] for r in book.answers().collect()}
    assert len(kept) == 20 and kept["v3"] is None and kept["v7"] is None  # each value once, though it stands in two rows
    lost = {k for k, v in kept.items() if v is None}
    out = enrich_journaled(rows, "v", "v", CountingClient(log2), book, "2", "answer", batch_size=4, backoff=None)
    assert out.columns == ["id", "v", "n", "answer", "attempts", "error", "run"] and out.count() == 42
    assert set(asked(log2)) == lost | {"x"}
    got = {r["id"]: r for r in out.collect()}
    assert all(got[i]["answer"] == f"V{i % 20}" and got[i]["error"] is None for i in range(40))
    assert all(got[i]["run"] == ("2" if f"v{i % 20}" in lost else "1") for i in range(40)) and {"v3", "v7"} <= lost and len(lost) < 10
    assert got[99]["answer"] is None and got[99]["error"] == "value_missing" and got[99]["attempts"] == 0
    before = sorted(book.answers().collect())
    book.compact()
    book.compact()
    assert sorted(book.answers().collect()) == before and book._finals() == [1]
    book.forget_calls()
    assert sorted(book.answers().collect()) == before
    assert book.ask(rows, "v", "v", CountingClient(log2), "3", backoff=None) == (0, 0)


def test_forget_needs_a_final_set(spark, tmp_dir):
    book = Journal(spark, os.path.join(tmp_dir, "book"))
    with pytest.raises(RuntimeError):
        book.forget_calls()
    assert enrich_journaled(spark.createDataFrame([], "k string"), "k", "k", CountingClient(tmp_dir), book, "1", backoff=None).collect() == []


RETRY = """
import json, os, sys
sys.path[:0] = [{repo!r}, {tests!r}]
from asrprep.session import get_spark
from asrprep.operators.journal import Journal
from test_lazy import CountingClient
class Dies(CountingClient):
    def __call__(self, values):
        mark = os.path.join({tmp!r}, "died")
        if "v17" in values and not os.path.exists(mark):
            open(mark, "w").close()
            os._exit(3)  # the worker is gone, no answer came
        return super().__call__(values)
spark = get_spark("local[1,4]", shuffle_partitions=1)
rows = spark.createDataFrame([(f"v{{i:02d}}",) for i in range(30)], "v string").coalesce(1)
print(Journal(spark, {tmp!r} + "/book").ask(rows, "v", "v", Dies({tmp!r} + "/log"), "1", batch_size=5, backoff=None, partitions=1))
"""


def test_retried_task_asks_only_for_what_is_missing(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "log"))
    here = os.path.dirname(os.path.abspath(__file__))
    code = RETRY.format(repo=os.path.dirname(here), tests=here, tmp=tmp_dir)
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([os.path.dirname(here), here])}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=env)
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.path.exists(os.path.join(tmp_dir, "died"))
    assert asked(os.path.join(tmp_dir, "log")) == [f"v{i:02d}" for i in range(30)]  # every value once, over both attempts
    assert len(Journal(spark, os.path.join(tmp_dir, "book")).answers().collect()) == 30


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_long_pairs_equal_the_full_matrix(spark):
    rnd = random.Random(9)
    pairs = []
    for n, edits in ((0, 0), (63, 5), (64, 70), (65, 0), (66, 16), (200, 17), (300, 64), (300, 400), (150, 2)):
        a = [f"w{rnd.randrange(40)}" for _ in range(n)]
        b = list(a)
        for _ in range(edits):
            at = rnd.randrange(len(b) + 1)
            kind = rnd.randrange(3)
            b[at:at + (kind < 2)] = [f"w{rnd.randrange(40)}"] * (kind > 0)
        pairs.append((a, b))
    pairs += [([f"a{i}" for i in range(100)], [f"b{i}" for i in range(90)]), ([], [f"b{i}" for i in range(90)])]
    df = spark.createDataFrame(pairs, "r array<string>, h array<string>")
    got = [r["n"] for r in df.select(scoring.word_edits("r", "h").alias("n")).collect()]
    assert got == [plain_distance(a, b) for a, b in pairs]


def test_near_equal_pair_of_20000_words_is_quick(spark):
    rnd = random.Random(10)
    a = [f"w{rnd.randrange(2000)}" for _ in range(20_000)]
    b = a[:5000] + ["x", "y"] + a[5003:15_000] + a[15_010:]
    df = spark.createDataFrame([(a, b)], "r array<string>, h array<string>")
    start = time.monotonic()
    assert df.select(scoring.word_edits("r", "h").alias("n")).collect()[0]["n"] == 13
    assert time.monotonic() - start < 20
