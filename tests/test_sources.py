import pytest
from pyspark.sql import functions as F

from hitscope.sources import (
    decode_messages,
    key_value_rows,
    read_kv_text,
    read_log_lines,
    sorted_pairs,
    write_kv_text,
)


def _pairs(df):
    return [tuple(r) for r in df.collect()]


def test_kv_text_roundtrip(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = [(3, "x"), (1, "a"), (1, ""), (2, "a\tb"), (2, "\r"), (4, " é ")]
    write_kv_text(key_value_rows(spark, rows), path)
    assert _pairs(sorted_pairs(read_kv_text(spark, path))) == sorted(rows)
    text = b"".join(f.read_bytes() for f in (tmp_path / "kv").glob("part-*")).decode()
    assert sorted(text.split("\n"))[1:] == sorted(f"{k}\t{v}" for k, v in rows)


def test_kv_text_with_nulls(spark, tmp_path):
    path = str(tmp_path / "kv")
    write_kv_text(key_value_rows(spark, [(1, None), (None, "v"), (None, None)]), path)
    assert sorted(_pairs(read_kv_text(spark, path)), key=str) == [(1, None), (None, None)]
    assert sorted(_pairs(read_kv_text(spark, path, "STRING"))) == [("1", None), ("v", None)]


def test_kv_text_refuses_a_line_feed(spark, tmp_path):
    with pytest.raises(Exception, match="line feed"):
        write_kv_text(key_value_rows(spark, [(1, "a\nb")]), str(tmp_path / "kv"))


def test_kv_text_does_not_overwrite_unasked(spark, tmp_path):
    path = str(tmp_path / "kv")
    write_kv_text(key_value_rows(spark, [(1, "a")]), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_kv_text(key_value_rows(spark, [(2, "b")]), path)
    write_kv_text(key_value_rows(spark, [(2, "b")]), path, mode="overwrite")
    assert _pairs(read_kv_text(spark, path)) == [(2, "b")]


def test_sorting_splits_a_hot_pair(spark):
    pairs = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ordered = sorted_pairs(pairs)
        per_task = ordered.groupBy(F.spark_partition_id()).count().select("count").collect()
        rows = _pairs(ordered)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r[0] for r in per_task) < 20_000
    assert rows == sorted(rows) and len(rows) == 90_000


def test_read_log_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    (tmp_path / "b.log").write_text("three")
    lines = lambda path: sorted(r.value for r in read_log_lines(spark, path).collect())
    assert lines(str(tmp_path)) == ["one", "three", "two"]
    assert lines(f"{tmp_path}/*.log") == ["one", "three", "two"]
    assert lines([f"{tmp_path}/a.log"]) == ["one", "two"]


def test_decode_messages(spark):
    messages = spark.createDataFrame(
        [(None, bytearray("é x".encode()), "weblogs", 0, 5), (None, None, "weblogs", 0, 6)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT",
    )
    decoded = decode_messages(messages, ["offset"])
    assert decoded.columns == ["offset", "value"]
    assert _pairs(decoded) == [(5, "é x"), (6, None)]
