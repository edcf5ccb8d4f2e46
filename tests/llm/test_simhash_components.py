"""Naming of components: the same ids whichever way the smallest ids reach their members."""

from asrprep.llm import simhash


def test_smallest_ids_of_small_and_hot_components(spark):
    linked = [(100 * r + i, 1000 - 7 * i if i % 5 else None, r) for r in range(1, 9) for i in range(3 * r)]
    df = spark.createDataFrame(linked, "fp long, first_id long, root long")
    want = {fp: min(i for _, i, q in linked if q == r and i is not None) for fp, _, r in linked}
    for hot_root, max_rows in ((1 << 20, 1000), (10, 0), (0, 0), (1 << 20, 0)):
        got = simhash._smallest_ids(df, hot_root, max_rows).collect()
        assert len(got) == len(linked) and {r["fp"]: r["component_id"] for r in got} == want
    assert simhash._smallest_ids(df.limit(0), 1, 0).collect() == []


def test_groups_with_and_without_links(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base), (9, base + " more"), (7, "quite other words stand here"), (None, "nobody names this text"), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()}
    assert got == {5: 3, 3: 3, 9: 3, 7: 7, None: None, 1: 1, 2: 1}
