"""Every query of the subpackage: against its SQL where it has one; and the pipeline."""

import os
import re

import corpus_pipeline
import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from stockweek.llm.queries import ORACLES, QUERIES
from stockweek.testbed.compare import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "benchmark", "labels", "conversations", "pages", "embeddings")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, name):
    found = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert found.same, found.detail


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_embedding_whitening"}))
def test_query_without_sql_covers_its_table(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(
        r[0] for r in docs.select("doc_id").collect()
    )


def test_each_operator_is_registered():
    registered = queries()
    for n in range(1, 14):
        assert len([q for q in registered if re.match(rf"op{n}_", q)]) == 1
    assert registered["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in oracle_sql()
