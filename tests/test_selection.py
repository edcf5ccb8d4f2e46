"""Selection of the k first rows without a sort."""

import random

import pytest
from pyspark.sql import functions as F

from asrprep.operators import manifest, sampling, selection


@pytest.fixture(params=[0, selection.MERGE], autouse=True)
def merge(request, monkeypatch):
    """Every test by histograms and by merged partitions."""
    monkeypatch.setattr(selection, "MERGE", request.param)
    monkeypatch.setattr(manifest, "MERGE", request.param)
    return request.param


def wanted(rows, k):
    return sorted(rows, key=lambda r: tuple((x is not None, x if not isinstance(x, str) else x.encode()) for x in r))[:k]


def check(spark, rows, kind, monkeypatch, ks):
    monkeypatch.setattr(selection, "SMALL", 3)
    monkeypatch.setattr(selection, "CELLS", 4)
    df = spark.createDataFrame(rows, kind).repartition(3).cache()
    for k in ks:
        got = [tuple(r) for r in selection.first_rows(df, [F.col(c) for c in df.columns], k).collect()]
        assert sorted(got, key=str) == sorted(wanted(rows, k), key=str), k
    df.unpersist()


def test_whole_numbers_with_ties_nulls_and_extremes(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, -2 ** 63, 2 ** 63 - 1, 0, 5, *range(-40, 40)]), rnd.choice([None, 1, 2])) for _ in range(120)]
    check(spark, rows, "a long, b int", monkeypatch, [0, 1, 7, 30, 61, 119, 120, 200])


def test_strings_with_ties_prefixes_and_unicode(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "", "a", "aa", "aaa", "aab", "ab", "é", "éa", "日本", "\U0001F600", "z" * 9]), rnd.choice(["x", None])) for _ in range(100)]
    check(spark, rows, "a string, b string", monkeypatch, [1, 9, 33, 50, 77, 99, 100])


@pytest.mark.parametrize("k", [1, 17, 199])
def test_equal_rows_are_cut_by_place(spark, k):
    df = spark.range(200).select(F.lit("same").alias("a")).repartition(5)
    assert selection.first_rows(df, [F.col("a")], k).count() == k


def test_hot_key_in_a_sample(spark):
    """A key of a third of all rows where the cut falls."""
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), "id")
    for k in (10, 100, 150, 250):
        got = sampling.sample_k(df, "key", k)
        assert got.count() == k and got.select("id").distinct().count() == k
    half = sampling.exact_fraction_sample(df, "key", 0.5, tie_col="id")
    assert half.count() == 150
    assert {r["id"] for r in half.collect()} == {r["id"] for r in sampling.exact_fraction_sample(df.repartition(7), "key", 0.5, tie_col="id").collect()}


def test_plans_hold_no_sort_and_no_exchange(spark, merge):
    if merge:
        pytest.skip("the merged form")
    df = spark.range(5000).select("id", F.col("id").cast("string").alias("text"))
    for out in (sampling.sample_k(df, "id", 40), sampling.exact_fraction_sample(df, "id", 0.3),
                manifest.select_backlog(df, df.where("id < 20").select("id"), "id", "text", 100)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Sort" not in plan and "Limit" not in plan and "RepartitionBy" not in plan
    assert sampling.exact_fraction_sample(df, "id", 0.3).count() == 1500
    assert [r["id"] for r in manifest.select_backlog(df, df.where("id < 20").select("id"), "id", "text", 3).orderBy("id").collect()] == [20, 21, 22]


def test_backlog_with_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "t"), (3, "t"), (3, "t"), (3, "t"), (1, None), (2, "t"), (9, "t")], "id long, text string")
    empty = df.where("false").select("id")
    for k, want in ((1, [None]), (2, [None, 2]), (4, [None, 2, 3, 3]), (6, [None, 2, 3, 3, 3, 9]), (50, [None, 2, 3, 3, 3, 9]), (0, [])):
        assert sorted((r["id"] for r in manifest.select_backlog(df, empty, "id", "text", k).collect()), key=lambda x: x or 0) == want
