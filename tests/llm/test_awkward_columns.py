"""Columns of documents that bear names the operators use, very small and large vectors, vectors of several lengths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitscope.llm import dart_minhash, line_dedup, nearest
from hitscope.llm.common import with_ids

LINE = "a line that two documents hold"


def test_line_counts_win_over_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, LINE, 77, "x"), (2, f"{LINE}\nown", 78, "y")], "doc_id long, text string, n_lines int, n_dropped string")
    counted = line_dedup.line_dedup(docs)
    assert sorted(tuple(r) for r in counted.select("doc_id", "text", "n_lines", "n_dropped").collect()) == [(1, LINE, 1, 0), (2, "own", 2, 1)]
    plain = line_dedup.line_dedup(docs, counts=False)
    assert plain.columns == docs.columns
    assert sorted(tuple(r) for r in plain.collect()) == [(1, LINE, 77, "x"), (2, "own", 78, "y")]


def test_one_of_each_group_whatever_the_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text, 5, 1), (2, text, 6, 2), (3, "another one", 7, 3), (None, text, 8, 4)], "doc_id long, text string, _kept int, sieve_page int")
    kept = dart_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r)[2:] for r in kept.collect()) == [(5, 1), (7, 3), (8, 4)]


@pytest.mark.parametrize("n", [0, 1, 40_000])
def test_rows_with_ids(spark, n):
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    ids = spark.range(0, 2 * n, 2).select(F.col("id").alias("doc_id"))
    assert sorted(r[0] for r in with_ids(docs, ids).select("doc_id").collect()) == list(range(0, 2 * n, 2))


@pytest.mark.parametrize("unit", [1e-300, 1e-200, 5e-324, 1e150, 1.0])
def test_vectors_of_any_size(spark, unit):
    """Their neighbours are those of the same vectors at an ordinary size, where scores differ at all."""
    rng = np.random.default_rng(2)
    points = np.round(rng.normal(size=(300, 8)) * 4)
    rows = [(i, (p * unit).tolist()) for i, p in enumerate(points) if np.any(p)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, F.col("vec_id") % 20 == 0, k=5).collect()
    assert {r["query_id"] for r in found} == set(range(0, 300, 20)) and len(found) == 75
    for r in found:
        assert r["score"] == float((points[r["query_id"]] * unit * (points[r["vec_id"]] * unit)).sum())


def test_every_length_is_a_space_of_its_own(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=(4 if i % 3 else 6)).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, F.col("vec_id") % 20 == 0, k=10, share=1.0).collect()
    vectors = dict(rows)
    for query in range(0, 400, 20):
        scores = {i: float((np.array(v) * np.array(vectors[query])).sum()) for i, v in rows if i != query and len(v) == len(vectors[query])}
        expected = sorted(scores, key=lambda i: (-scores[i], i))[:10]
        assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == query] == expected
