"""The pipeline's stages keep their contract, and the registered queries match their oracles."""

import pytest

import corpus_pipeline
from tidemark.llm import queries as Q
from tidemark.plans.verify import compare, duckdb_connection

from helpers import SMALL, odd_documents


def test_stages_on_the_smallest_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, size = [], docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs.count())
    assert seen[0] < size and seen[1] == seen[0] and seen[2] < seen[1] and seen[3] < seen[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == seen[3]
    whole = corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "start", "length", "ids_crc32")
    parts = packed.select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(whole.collect()) == sorted(parts.collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_each_stage_takes_odd_and_no_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    odd = odd_documents(spark)
    assert stage(spark, odd, SMALL).count() >= 8
    assert stage(spark, odd.limit(0), SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_its_oracle(spark, name):
    outcome = compare(spark, duckdb_connection(SMALL), name, SMALL, Q.queries(), Q.oracle_sql())
    assert outcome.ok, outcome.detail


def test_queries_are_complete():
    assert [n.split("_")[0] for n in Q.queries()] == [f"op{k}" for k in range(1, 14)]
