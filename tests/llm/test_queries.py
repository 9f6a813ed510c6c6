"""Registered queries on the smallest data, with their SQL where there is one, and the pipeline stage by stage."""

import os

import pytest

from tests.llm import brute
from tests.llm.test_near_copies import groups as exact_groups
from tests.oracle import compare, connect
from twinproof.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, connect(SF), ORACLE[name]) is None
    else:
        df.collect()


def test_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    import __spark_entry__
    import corpus_pipeline

    assert "pipeline" in __spark_entry__.queries()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        assert after.columns[: len(columns)] == columns, name
        ids, kept = {r.doc_id for r in before.select("doc_id").collect()}, {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= ids and kept
        if name == "SimHash near-dedup":
            given = sorted(tuple(r) for r in before.select("doc_id", "text").collect())
            roots, _ = exact_groups([t for _, t in given])
            assert kept == {given[i][0] for i in set(roots.values())}
        if name == "PII":
            assert kept == ids
            assert not [r for r in after.collect() if brute.spans(r.text, brute.PII[:1], False)[1]]
        before = after
    assert corpus_pipeline.run(spark, SF).count() == before.count()
