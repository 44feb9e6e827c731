"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tidemark.plans import catalog
from tidemark.plans.verify import compare, duckdb_connection

from conftest import SMALL

# The training-data queries have tests of their own (tests/llm).
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, con, name, SMALL, entry.queries(), entry.oracle_sql())
    assert out.ok, out.detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "health_status" in df.columns


SPARK_TO_DUCKDB = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                   "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_result_types_match_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SMALL)
    spark_types = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(catalog.oracle_sql()[name])
    oracle_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == oracle_types
