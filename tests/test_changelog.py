"""Changelogs over time: folds, runs and replays."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hitscope import operators as op
from hitscope.streaming import append_batch, await_all, compact_changelog, read_changelog, start_query, stream_session
from hitscope.streaming import compaction
from hitscope.streaming.folders import Folder
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

SCHEMA = StructType([StructField("status", IntegerType()), StructField("requests", LongType())])


def _write(spark, path, batches, start=0):
    sink = append_batch(path=str(path))
    for n, rows in enumerate(batches, start):
        sink(spark.createDataFrame(rows, SCHEMA), n)


def _fold(spark, path):
    return sorted((tuple(r) for r in op.latest_counts(read_changelog(spark, str(path), SCHEMA), ["status"]).collect()), key=str)


BATCHES = [[(200, 1), (None, 1)], [(200, 3), (404, 1)], [(404, 2)], [(None, 7), (500, 1)], [(200, 4)]]
FOLD = [(200, 4), (404, 2), (500, 1), (None, 7)]


def _names(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith("."))


def test_a_fold_keeps_the_counts_and_drops_the_rest(spark, tmp_path):
    _write(spark, tmp_path, BATCHES)
    assert _fold(spark, tmp_path) == FOLD
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA, up_to=1) == 1
    assert _fold(spark, tmp_path) == FOLD
    assert read_changelog(spark, str(tmp_path), SCHEMA).where("batch_id <= 1").count() == 3
    # Readers of the state before may still be at work: nothing is gone as yet.
    assert [n for n in _names(tmp_path) if n.startswith("batch_id")] == [f"batch_id={i}" for i in range(5)]
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA) == 3
    assert [n for n in _names(tmp_path) if n.startswith("batch_id")] == [f"batch_id={i}" for i in (2, 3, 4)]
    assert _fold(spark, tmp_path) == FOLD
    assert read_changelog(spark, str(tmp_path), SCHEMA).count() == 5
    _write(spark, tmp_path, [[(500, 9)], [(301, 1)]], start=5)
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA) == 5
    assert _fold(spark, tmp_path) == [(200, 4), (301, 1), (404, 2), (500, 9), (None, 7)]
    assert len(list((tmp_path / "_base").glob("[0-9]*"))) == 2
    assert sorted(p.name for p in (tmp_path / "_manifest").glob("[0-9]*")) == ["3", "5"]


def test_only_closed_batches_are_folded(spark, tmp_path):
    _write(spark, tmp_path, BATCHES[:2])
    with pytest.raises(ValueError, match="not closed"):
        compact_changelog(spark, str(tmp_path), ["status"], SCHEMA, up_to=1)
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA) == 0
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA) == 0
    lone = tmp_path / "lone"
    _write(spark, lone, BATCHES[:1])
    assert compact_changelog(spark, str(lone), ["status"], SCHEMA) is None


def test_a_fold_that_is_killed_between_its_steps(spark, tmp_path, monkeypatch):
    _write(spark, tmp_path, BATCHES)
    compact_changelog(spark, str(tmp_path), ["status"], SCHEMA, up_to=0)

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Folder, "write_once", killed)
        with pytest.raises(KeyboardInterrupt):
            compact_changelog(spark, str(tmp_path), ["status"], SCHEMA)
    assert _fold(spark, tmp_path) == FOLD and compaction.manifest(Folder(spark, str(tmp_path)))["up_to"] == 0
    with monkeypatch.context() as m:
        m.setattr(compaction, "_remove_replaced", killed)
        with pytest.raises(KeyboardInterrupt):
            compact_changelog(spark, str(tmp_path), ["status"], SCHEMA, up_to=2)
    assert _fold(spark, tmp_path) == FOLD
    assert compact_changelog(spark, str(tmp_path), ["status"], SCHEMA) == 3
    assert _fold(spark, tmp_path) == FOLD
    assert len(list((tmp_path / "_base").glob("[0-9]*"))) == 2


def _stream(spark, source, checkpoint, sink):
    counts = stream_session(spark, 2).readStream.schema("status INT").json(str(source)).groupBy("status").agg(F.count("*").alias("requests"))
    query = start_query(counts, f"changelog-{checkpoint.name}", str(checkpoint), sink, trigger={"availableNow": True})
    await_all([query])


def _arrive(source, *statuses):
    source.mkdir(exist_ok=True)
    number = len(list(source.iterdir()))
    (source / f"{number:03d}.json").write_text("".join(f'{{"status": {s}}}\n' for s in statuses))


def test_a_new_checkpoint_is_refused_on_a_folder_with_one_batch(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    _arrive(source, 200, 200, 404)
    _stream(spark, source, tmp_path / "first", append_batch(path=str(out)))
    assert [n for n in _names(out) if n.startswith("batch")] == ["batch_id=0"]
    before = _fold(spark, out)
    _arrive(source, 500)
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        _stream(spark, source, tmp_path / "second", append_batch(path=str(out)))
    assert _fold(spark, out) == before == [(200, 2), (404, 1)]
    _stream(spark, source, tmp_path / "first", append_batch(path=str(out)))
    assert _fold(spark, out) == [(200, 2), (404, 1), (500, 1)]


def test_batches_without_a_run_id_are_not_taken_for_those_of_a_new_one(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    _write(spark, out, BATCHES[:1])
    _arrive(source, 200)
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        _stream(spark, source, tmp_path / "first", append_batch(path=str(out)))
    assert _fold(spark, out) == [(200, 1), (None, 1)]


def _row_store():
    """A store that is no folder of batches: appends rows one by one, keeps those of failed writes, and can be read."""
    import json
    import os
    import uuid

    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

    class Writer(DataSourceWriter):
        def __init__(self, place):
            self.place = place

        def write(self, rows):
            for row in rows:
                if os.path.exists(f"{self.place}-fails") and row["status"] == 500:
                    raise RuntimeError("the store is lost")
                with open(f"{self.place}/{uuid.uuid4().hex}", "w") as f:
                    json.dump(list(row), f)
            return WriterCommitMessage()

    class Reader(DataSourceReader):
        def __init__(self, place):
            self.place = place

        def read(self, partition):
            for name in os.listdir(self.place):
                with open(f"{self.place}/{name}") as f:
                    yield tuple(json.load(f))

    class RowStore(DataSource):
        @classmethod
        def name(cls):
            return "rowstore"

        def schema(self):
            return "status INT, requests BIGINT, run_id STRING, batch_id BIGINT"

        def reader(self, schema):
            return Reader(self.options["place"])

        def writer(self, schema, overwrite):
            return Writer(self.options["place"])

    return RowStore


@pytest.mark.parametrize("lost", ["within", "after"])
def test_a_ledger_keeps_replays_out_of_a_store_without_folders(spark, tmp_path, lost):
    """A batch fails within its append or after it, and runs again."""
    source, store = tmp_path / "in", tmp_path / "store"
    store.mkdir()
    sink = append_batch("rowstore", ledger=str(tmp_path / "ledger"), place=str(store))

    def replayed(batch, batch_id):
        batch.sparkSession.dataSource.register(_row_store())
        sink(batch.coalesce(1).orderBy("status"), batch_id)
        if (tmp_path / "store-fails").exists():
            raise RuntimeError("lost after the append")
        sink(batch, batch_id)

    _arrive(source, 200, 200, 404)
    _stream(spark, source, tmp_path / "checkpoint", replayed)
    _arrive(source, 200, *([500, 500] if lost == "within" else [301, 301]))
    (tmp_path / "store-fails").write_text("")
    with pytest.raises(StreamingQueryException, match="lost"):
        _stream(spark, source, tmp_path / "checkpoint", replayed)
    assert len(list(store.iterdir())) == (3 if lost == "within" else 4)
    (tmp_path / "store-fails").unlink()
    _stream(spark, source, tmp_path / "checkpoint", replayed)
    _arrive(source, 404)
    _stream(spark, source, tmp_path / "checkpoint", replayed)
    spark.dataSource.register(_row_store())
    rows = sorted((r.batch_id, r.status, r.requests) for r in spark.read.format("rowstore").options(place=str(store)).load().collect())
    assert rows == sorted([(0, 200, 2), (0, 404, 1), (1, 200, 3), (1, 500 if lost == "within" else 301, 2), (2, 404, 2)])


def test_a_path_takes_no_ledger(tmp_path):
    with pytest.raises(ValueError, match="no ledger"):
        append_batch(path=str(tmp_path), ledger=str(tmp_path))
