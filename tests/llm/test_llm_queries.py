"""The pipeline on a small table, and the queries that have SQL."""

import os

import duckdb
import pytest

import corpus_pipeline
from hitscope.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_line_dedup", "op9_substring_dedup"])
def test_against_sql(spark, name):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{os.path.join(SF, 'documents.parquet')}'")
    columns = sorted(QUERIES[name](spark, SF).columns)
    expected = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, QUERIES[name](spark, SF).select(*columns).collect())) == sorted(expected)


def test_pipeline_keeps_its_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:3]:
        assert stage(spark, docs, SF).columns == docs.columns, name
