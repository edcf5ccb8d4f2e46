"""Registered queries of the subpackage: SQL oracles and the pipeline at the smallest scale."""

import duckdb
import pytest

import corpus_pipeline
from asrprep.llm import queries
from conftest import SF001


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    r = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in r.description]
    got = queries.QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(cols)
    # rows as Python values: pandas shows whole numbers with nulls differently by origin
    assert sorted(map(repr, (tuple(x) for x in got.select(*cols).collect()))) == sorted(map(repr, r.fetchall()))


def test_pipeline(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        stage(spark, docs, SF001).write.parquet(f"{tmp_dir}/{k}")
        docs = spark.read.parquet(f"{tmp_dir}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= seen
            seen = docs.count()
        else:
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == ids
    again = corpus_pipeline.run(spark, SF001)
    assert again.agg({"length": "sum"}).collect() == docs.agg({"length": "sum"}).collect()


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0
