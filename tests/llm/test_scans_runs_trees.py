"""License scan, periodic runs and Merkle manifest against brute force, and on awkward tables."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asrprep.llm import licenses, merkle, periodic_runs, queries, wordcols
from conftest import SF001

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row long, tree long, runs string, blocks int"
WS = r"[^\x20\x09-\x0D]+"


def row(i, text, lang="en", source="s", n=3):
    return (i, text, lang, source, n, True, 7, 8, "x", 9)


NOTICE = licenses.TEMPLATES[1][1]
AWKWARD = [
    row(1, None), row(2, ""), row(3, " \t\n"), row(4, "A x\x00y É ſ\x1c Under the MIT-license, under THE mit license."),
    row(5, " ".join(f"w{i % 977}" for i in range(30_000)) + " Apache License version 2 " + "z " * 5000, None, None, None),
    row(6, "cc by NC. cc by nc 4", "de"), row(6, "cc by NC. cc by nc 4", "de"), row(None, "a b c d"), row(None, None, None, None, None),
    row(7, "la la la la la la la la la la la la", "", ""), row(8, NOTICE.upper(), "fr"), row(9, "ee " * 3 + NOTICE + " ff", "fr"),
    row(10, " ".join(w for i, w in enumerate(NOTICE.split()) if i % 2)), row(11, "reserved are all RIGHTS"), row(-12, "license the mit under")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3, "source")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return tuple((v is None, v) for v in x)


# words

def test_words_of_columns():
    rnd = random.Random(1)
    texts = [None, "", "a"] + ["".join(chr(rnd.choice([0, 32, 10, 11, 28, 45, 65, 90, 97, 122, 127, 133, 160, 233, 0x3000, 0x1F600]))
                                       for _ in range(rnd.randrange(30))) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    ways = [(wordcols.space_table(), WS, lambda t: t), (wordcols.byte_table(licenses.SEPARATORS, True), licenses.WORD, licenses.lower_ascii)]
    for table, pattern, change in ways:
        for at in (0, 1, 5):
            for part in wordcols.slices(batch.slice(at), 0, 200):
                flat, offsets = wordcols.words(part.column(0), table)
                got = [flat.to_pylist()[a:b] for a, b in zip(offsets, offsets[1:])]
                assert got == [re.findall(pattern, change(t or "")) for t in part.column(0).to_pylist()]


# license scan

def brute_scan(rows, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    out = []
    for r in rows:
        ws = licenses.words_of(r[1] or "")
        base = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()]
        found = []
        for label, text in templates:
            t = set(licenses.words_of(text))
            w = licenses.stride(len(licenses.words_of(text)))
            for at in range(0, max(1, len(ws)), w):
                n = len(t & set(ws[at:at + 2 * w]))
                if n >= licenses.needed(len(t), threshold):
                    found.append((n / len(t), label))
        labels = {label for _, label in base}
        out.append((r[0], len(ws), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {x for _, x in found})),
                    1.0 if base else max(found, default=(0.0,))[0]))
    return sorted(out, key=key)


def test_license_scan(awkward, empty):
    got = sorted((tuple(r) for r in licenses.scan(awkward).drop("blocks").collect()), key=key)
    assert got == brute_scan(AWKWARD)
    by = {r[0]: r for r in got}
    assert by[8][6] == by[9][6] == "mit" and by[8][5] == "" and by[11][6] == "all-rights-reserved" and by[4][5] == "mit" and by[1][7] == 0
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_license_join_is_exact(spark, threshold):
    """Random texts of few words: many pairs near the threshold."""
    rnd, alphabet = random.Random(7), [f"w{i}" for i in range(14)]
    templates = [(f"l{i % 7}", " ".join(rnd.choices(alphabet, k=rnd.randrange(1, 20)))) for i in range(12)]
    rows = [row(i, " ".join(rnd.choices(alphabet + ["z", "y"], weights=[1 / (k + 1) for k in range(16)], k=rnd.randrange(0, 90)))) for i in range(150)]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA), templates=templates, threshold=threshold).drop("blocks")
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute_scan(rows, templates, threshold)


def test_license_spans_lie_in_a_block():
    for n in range(1, 70):
        w = licenses.stride(n)
        assert all(any(k * w <= at and at + n <= (k + 2) * w for k in range(at // w + 1)) for at in range(3 * w))


# periodic runs

def brute_runs(ws, least=12):
    found = {}
    for p in range(1, len(ws) // 2 + 1):
        i = 0
        while i + p < len(ws):
            j = i
            while j + p < len(ws) and ws[j] == ws[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def collapse(ws, runs):
    gone = {x for a, n, p in runs for x in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def strings(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        kind, some = rnd.randrange(5), lambda k, m: [rnd.choice("abcdefgh"[:k]) for _ in range(rnd.randrange(m))]
        if kind == 0:
            yield some(rnd.randrange(1, 4), 70)
        elif kind == 1:
            block = some(4, 45) or ["a"]
            yield some(8, 6) + (block * 6)[:rnd.randrange(1, 250)] + some(8, 6)
        elif kind == 2:
            a, b = ["a"], ["a", "b"]
            for _ in range(rnd.randrange(9)):
                a, b = b, b + a
            yield b
        elif kind == 3:
            w = some(2, 40) * rnd.randrange(1, 6)
            if w:
                w[rnd.randrange(len(w))] = "z"
            yield w
        else:
            yield []


@pytest.mark.parametrize("least", [1, 2, 5, 12, 40])
def test_runs_equal_brute_force(least):
    for seed in range(25):
        lists = list(strings(1000 * least + seed, 30))
        part = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array([" ".join(w) for w in lists])], names=["i", "t"])
        for got, ws in zip(periodic_runs._of_slice(part, least, wordcols.space_table()).to_pylist(), lists):
            want = brute_runs(ws, least)
            assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
            assert got["collapsed"] == collapse(ws, want) and got["n_words"] == len(ws)


def test_levels_watch_every_period_with_a_block_inside():
    for least in (1, 2, 7, 12, 40, 100):
        seen = []
        for s, first, last in periodic_runs._levels(700, least):
            seen += range(first, last + 1)
            assert all(2 * s - 1 <= max(least - p, p) for p in range(first, last + 1))
        assert seen == list(range(1, 351))


def test_runs_of_awkward_and_long_texts(spark, awkward, empty):
    want = collections.Counter()
    for r in AWKWARD:
        ws = re.findall(WS, r[1] or "")
        runs = brute_runs(ws) if len(ws) < 1000 else [(30_004, 5000, 1)]
        want[(r[0], len(ws), tuple(runs), collapse(ws, runs))] += 1
    got = collections.Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"])
                              for r in periodic_runs.periodic_runs(awkward).collect())
    # the long text's own cycle of 977 words is a run as well
    assert set(got) - set(want) == {k for k in got if k[0] == 5} and len(got) == len(want)
    (five,) = [k for k in got if k[0] == 5]
    assert five[2] == ((0, 30_000, 977), (30_004, 5000, 1)) and five[1] == 35_004
    assert periodic_runs.periodic_runs(empty).count() == 0
    one = spark.createDataFrame([row(1, "a b " * 300_000)], SCHEMA)
    assert [tuple(r) for r in periodic_runs.periodic_runs(one).select("runs").first()["runs"]] == [(0, 600_000, 2)]


def test_runs_take_a_large_batch_in_bounded_memory():
    """Five megabytes in one Arrow batch: the same rows as from small batches, and arrays of a megabyte's size only."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("ab cd ef gh".split()) + str(rng.randrange(30)) for _ in range(400)) + " x y" * 20 for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    assert batch.nbytes > 5 << 20
    tracemalloc.start()
    got = [b.num_rows for b in periodic_runs._of_batches(iter([batch]), 12)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(got) == len(texts) and peak < 64 << 20
    few = [b.to_pylist() for n in (1, 40) for b in periodic_runs._of_batches((batch.slice(i, n) for i in range(0, 40, n)), 12)]
    assert [r for b in few[:-1] for r in b] == few[-1] and all(r["runs"] for r in few[-1])


def brute_op12(rows):
    out = []
    for r in rows:
        doc_id, ws = r[0], re.findall(WS, r[1] or "")
        h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(ws)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(ws)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        out.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                    hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
                    hashlib.sha256(collapse(ws, runs).encode()).hexdigest()))
    return sorted(out, key=key)


def test_op12_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    docs = [d for d in docs if len(d[1] or "") < 6000]
    got = queries.op12_periodic_runs(spark, SF001).where(F.col("doc_id").isin([d[0] for d in docs])).collect()
    assert sorted((tuple(r) for r in got), key=key) == brute_op12(docs)
    assert sum(r["n_runs"] > 0 for r in got) > 5


def test_planted_repeats_of_awkward(awkward):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    docs = awkward.sparkSession.createDataFrame([(ids[0], None), (ids[1], " \n"), (ids[2], "a b c d e f g h"), (None, " x\ty ")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in queries.planted_repeats(docs).collect()}
    assert (got[ids[0]] or "") == "" and got[ids[1]] == "" and len(got[ids[2]].split()) == 8 and got[None] == " x\ty "


# Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """(root, siblings by leaf from the lowest level up, as pairs of before and behind)"""
    paths, under, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        runs = [range(i, min(i + 8, len(level))) for i in range(0, len(level), 8)]
        for run in runs:
            for i in run:
                for x in under[i]:
                    paths[x].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        under = [[x for i in run for x in under[i]] for run in runs]
        level = [sha(*(level[i] for i in run)) for run in runs]
    return level[0], paths


def brute_merkle(rows):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha(part(r[0]), part(r[3]), part(r[2]), part(r[4]), part(text))

    groups = collections.defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
        groups[(r[2] is not None, (r[2] or "").encode())].append(((r[0] is not None, r[0] or 0), leaf(r, r[1]), r[0], leaf(
            r, licenses.lower_ascii(r[1])) if changed else leaf(r, r[1])))
    order = sorted(groups)
    trees = [brute_tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])]) for g in order]
    root, tops = brute_tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for g, (sub, paths), top in zip(order, trees, tops):
        for (_, own, doc_id, acc), path in zip(sorted(groups[g], key=lambda x: x[:2]), paths):
            for a, b in path + top:
                acc = sha(a, acc, b)
            out.append((doc_id, own, sub, root, sha(*(a + b for a, b in path + top)), acc, acc == root))
    return sorted(out, key=key)


def test_merkle_of_awkward(awkward, empty, spark, monkeypatch):
    def of(docs):
        monkeypatch.setattr(queries, "table", lambda *_: docs)
        return sorted((tuple(r) for r in queries.op13_merkle_manifest(spark, "").collect()), key=key)

    assert of(awkward) == brute_merkle(AWKWARD)
    assert of(empty) == []
    one = [row(3, "Only One", None)]
    assert of(spark.createDataFrame(one, SCHEMA)) == brute_merkle(one)
    rnd = random.Random(4)
    many = [row(rnd.randrange(10 ** 6), "Text É" * rnd.randrange(3), rnd.choice([None, "", "en", "de"] + [f"l{i}" for i in range(12)] + ["en"] * 30))
            for _ in range(700)] + [row(5, f"t{i}", "xx") for i in range(64)] + [row(5, "t", "yy")] * 9
    got = of(spark.createDataFrame(many, SCHEMA).repartition(5))
    assert got == brute_merkle(many)
    assert {r[6] for r in got} == {True, False}


def test_merkle_proof_finds_a_changed_leaf(spark):
    leaves = spark.range(100).select(F.lit("g").alias("grp"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    out = merkle.manifest(leaves)
    other = F.sha2(F.lit("other"), 256)
    assert out.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert out.where(merkle.fold(other, F.col("path")) == F.col("root")).count() == 0
    assert out.select("root").distinct().count() == 1 and np.all([len(r["path"]) == 3 for r in out.select("path").collect()])


@pytest.mark.parametrize("name", ["op11_license_scan", "op13_merkle_manifest"])
def test_sql_of_awkward(awkward, spark, monkeypatch, name):
    monkeypatch.setattr(queries, "table", lambda *_: awkward.where("doc_id != 5 or doc_id is null"))
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist(
        [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in AWKWARD if r[0] != 5]))
    want = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, "").select(*cols).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(want.fetchall(), key=key)
