"""Registered queries against their SQL, their columns, and the pipeline."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from llm_rows import EDGES, SF
from oracle_check import compare, duck
from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES


def test_registered():
    assert {f"op{k}" for k in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) and "pipeline" not in oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    ok, columns, ns, nd, *_ = compare(spark, name, QUERIES[name], ORACLE[name], SF, duck(SF))
    assert columns and ns == nd and ok


def test_pipeline_on_edges(spark, make, workdir):
    """Every stage keeps the columns of documents, and takes nulls, repeats and nothing."""
    for name, rows in (("edges", EDGES), ("empty", [])):
        docs = make(rows)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            out.write.parquet(path := f"{workdir}/{name}-{k}")
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(rows)


def test_pipeline_stages_agree_with_their_operators(spark):
    """On whole tables: rejected languages, repeated lines and copies are gone, sources are near their targets."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).select("doc_id", "source", "n_tokens").collect()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in out} <= ids and all(r.n_tokens >= 0 for r in out)
    assert len(out) > len(ids) / 2
