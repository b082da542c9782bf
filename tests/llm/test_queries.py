"""Registered queries against their SQL on whole tables, and the pipeline."""

import pytest
from compare import compare, connect

import corpus_pipeline
from adloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], ORACLES.get(name)) is None


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_stages(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
        docs = docs.cache()
        assert docs.columns == before.columns, name
        assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty(), name
        # Mixing repeats documents of cells that are asked for more than they have.
        assert 0 < docs.select("doc_id").distinct().count() < before.select("doc_id").distinct().count(), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_stages_on_awkward_rows(spark, sf_dir, awkward, no_docs):
    for docs in (awkward, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            docs.count()
