"""Streams over a growing folder of text files."""

import itertools
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from hitscope import operators as op
from hitscope.plans.inputs import log_lines
from hitscope.sources import read_log_stream
from hitscope.streaming import (
    ALERT_KEYS,
    append_batch,
    await_all,
    read_changelog,
    start_alerts,
    start_query,
    stream_session,
)

SF_DIR = "/root/testdata/sf0.01"
_names = (f"query_{i}" for i in itertools.count())


@pytest.fixture(scope="module")
def lines(spark):
    rows = log_lines(spark, SF_DIR, burst=True).orderBy("event_id").collect()
    return [r.value for r in rows]


def _write(folder, lines, files):
    folder.mkdir(exist_ok=True)
    start = len(list(folder.iterdir()))
    size = -(-len(lines) // files)
    for i in range(files):
        path = folder / f"{start + i:03d}.log"
        path.write_text("".join(line + "\n" for line in lines[i * size:(i + 1) * size]))
        # The source reads in order of modification time.
        os.utime(path, (1_700_000_000 + start + i,) * 2)


def _stream(spark, folder):
    session = stream_session(spark, state_partitions=2)
    return read_log_stream(session, "text", {"path": str(folder), "maxFilesPerTrigger": "1"})


def _run(results, tmp_path, **kwargs):
    query = start_query(
        results,
        next(_names),
        str(tmp_path / "checkpoint"),
        kwargs.pop("sink", append_batch(path=str(tmp_path / "out"))),
        trigger={"availableNow": True},
        **kwargs,
    )
    await_all([query])
    return query


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _batch(spark, lines):
    return op.parse_stream_tokens(spark.createDataFrame([(v,) for v in lines], "value STRING"))


@pytest.mark.parametrize("name", ALERT_KEYS)
def test_stream_folds_to_the_batch_result(spark, lines, tmp_path, name):
    alert = getattr(op, name)
    _write(tmp_path / "in", lines, 4)
    results = alert(op.parse_stream_tokens(_stream(spark, tmp_path / "in")))
    _run(results, tmp_path)
    changelog = read_changelog(spark, str(tmp_path / "out"), results.schema)
    assert changelog.select("batch_id").distinct().count() == 4
    expected = _rows(alert(_batch(spark, lines)))
    assert expected
    assert _rows(op.latest_counts(changelog, ALERT_KEYS[name])) == expected
    # Update mode emits a key again whenever its count has changed.
    assert changelog.count() > len(expected) or name == "trending_products"


def test_alerts_start_together(spark, lines, tmp_path):
    _write(tmp_path / "in", lines, 2)
    logs = op.parse_stream_tokens(_stream(spark, tmp_path / "in"))
    queries = start_alerts(
        logs,
        str(tmp_path / "checkpoints"),
        lambda name: append_batch(path=str(tmp_path / name)),
        trigger={"availableNow": True},
    )
    await_all(queries)
    assert [q.name for q in queries] == list(ALERT_KEYS)
    for name, keys in ALERT_KEYS.items():
        alert = getattr(op, name)
        changelog = read_changelog(spark, str(tmp_path / name), alert(logs).schema)
        assert _rows(op.latest_counts(changelog, keys)) == _rows(alert(_batch(spark, lines)))


def test_restart_continues_from_the_checkpoint(spark, lines, tmp_path):
    half = len(lines) // 2
    results = lambda: op.status_counts(op.parse_stream_regex(_stream(spark, tmp_path / "in")))
    _write(tmp_path / "in", lines[:half], 2)
    _run(results(), tmp_path)
    _write(tmp_path / "in", lines[half:], 2)
    _run(results(), tmp_path)
    changelog = read_changelog(spark, str(tmp_path / "out"), results().schema)
    assert sorted(r[0] for r in changelog.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    expected = _rows(op.status_counts(op.parse_stream_regex(
        spark.createDataFrame([(v,) for v in lines], "value STRING"))))
    assert _rows(op.latest_counts(changelog, ["status"])) == expected
    assert any(status is None for status, _ in expected)


def test_a_batch_that_runs_again_replaces_itself(spark, lines, tmp_path):
    """The sink fails after writing; the restarted query writes the batch once more."""
    _write(tmp_path / "in", lines, 2)
    write = append_batch(path=str(tmp_path / "out"))

    def fails_after_writing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    results = lambda: op.suspicious_ips(op.parse_stream_tokens(_stream(spark, tmp_path / "in")))
    with pytest.raises(StreamingQueryException):
        _run(results(), tmp_path, sink=fails_after_writing)
    before = read_changelog(spark, str(tmp_path / "out"), results().schema).count()
    _run(results(), tmp_path)
    changelog = read_changelog(spark, str(tmp_path / "out"), results().schema)
    assert changelog.count() == before
    assert _rows(op.latest_counts(changelog, ALERT_KEYS["suspicious_ips"])) == _rows(
        op.suspicious_ips(_batch(spark, lines)))


def test_a_repeated_append_does_not_change_the_fold(spark):
    append_batch("noop")(spark.createDataFrame([(200, 5)], "status INT, requests BIGINT"), 3)
    appended = [(200, 5, 0), (404, 1, 0), (200, 9, 1), (200, 9, 1)]
    table = spark.createDataFrame(appended, "status INT, requests BIGINT, batch_id BIGINT")
    assert _rows(op.latest_counts(table, ["status"])) == [(200, 9), (404, 1)]


def test_another_checkpoint_is_refused(spark, lines, tmp_path):
    _write(tmp_path / "in", lines[:80], 4)
    results = lambda: op.status_counts(op.parse_stream_regex(_stream(spark, tmp_path / "in")))
    _run(results(), tmp_path)
    sink = append_batch(path=str(tmp_path / "out"))
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        _run(results(), tmp_path / "anew", sink=sink)


def test_all_rows_of_a_batch_are_printed(spark, capsys):
    from hitscope.streaming import print_batch

    print_batch(spark.range(50), 3)
    assert capsys.readouterr().out.split() == ["batch", "3", "id", *map(str, range(50))]


def test_a_batch_in_fewer_files(spark, tmp_path):
    out = tmp_path / "out"
    append_batch(path=str(out), files=2)(spark.range(0, 1000, 1, 8), 5)
    assert len(list((out / "batch_id=5").glob("part-*"))) == 2
    assert spark.read.parquet(str(out)).count() == 1000


def test_changelog_before_the_first_batch(spark, tmp_path):
    schema = spark.createDataFrame([], "status INT, requests BIGINT").schema
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_changelog(spark, str(tmp_path / "none"), schema)
    changelog = read_changelog(spark, str(tmp_path / "none"), schema, missing_ok=True)
    assert changelog.columns == ["status", "requests", "batch_id"]
    assert _rows(op.latest_counts(changelog, ["status"])) == []


def test_append_mode_emits_closed_windows_only(spark, tmp_path):
    line = '1.1.1.1 - - [10/Feb/2025:07:{:02d}:00 +0000] "GET /x HTTP/1.1" 404 5'
    _write(tmp_path / "in", [line.format(m) for m in (1, 2, 6, 30, 31, 3)], 6)
    logs = op.parse_stream_tokens(_stream(spark, tmp_path / "in"))
    with pytest.raises(AnalysisException, match="append|Append"):
        _run(op.error_spikes(logs), tmp_path / "refused", mode="append")
    results = op.error_spikes(logs, watermark="10 minutes")
    _run(results, tmp_path, mode="append")
    closed = read_changelog(spark, str(tmp_path / "out"), results.schema)
    # 07:03 came after its window had closed (late rows are held against the
    # watermark of the batch before); the window of 07:30 is still open.
    assert _rows(closed.select("window_start", "status", "requests")) == [
        (datetime(2025, 2, 10, 7, 0), 404, 2), (datetime(2025, 2, 10, 7, 5), 404, 1)]


def test_console_and_memory_sinks(spark, tmp_path):
    _write(tmp_path / "in", ['1.1.1.1 - - [10/Feb/2025:07:01:00 +0000] "GET /x HTTP/1.1" 404 5'], 1)
    logs = op.parse_stream_tokens(_stream(spark, tmp_path / "in"))
    query = _run(op.status_counts(logs), tmp_path / "console", sink="console")
    assert [p["numInputRows"] for p in query.recentProgress] == [1]
    query = _run(op.status_counts(logs), tmp_path / "memory", sink="memory", mode="complete")
    assert _rows(logs.sparkSession.table(query.name)) == [(404, 1)]


def test_waiting_raises_when_any_query_fails(spark, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    _write(tmp_path / "in", ["x"], 1)
    logs = op.parse_stream_tokens(_stream(spark, tmp_path / "in"))
    lasting = start_query(op.status_counts(logs), next(_names), str(tmp_path / "a"), "noop")
    failing = start_query(op.status_counts(logs), next(_names), str(tmp_path / "b"), fail)
    try:
        with pytest.raises(StreamingQueryException, match="sink is down"):
            await_all([lasting, failing])
        assert lasting.isActive
    finally:
        lasting.stop()


def test_the_stream_session_leaves_the_callers_alone(spark):
    session = stream_session(spark, state_partitions=3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_alerts_that_are_told_once(spark, tmp_path):
    """Counts cross their limits in several batches and a restart; lines that come after a window's end count no more."""
    from hitscope.streaming.crossings import alerts_once

    line = '{} - - [10/Feb/2025:07:{:02d}:00 +0000] "GET /x HTTP/1.1" {} 5'
    rules = op.alert_rules(suspicious_more_than=4, spike_more_than=2)

    def batch(*rows):
        _write(tmp_path / "in", [line.format(*row) for row in rows for _ in range(row[3])], 1)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        results = alerts_once(op.parse_stream_tokens(_stream(spark, tmp_path / "in")), rules, watermark="1 minute")
        _run(results, tmp_path)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        changelog = read_changelog(spark, str(tmp_path / "out"), results.schema)
        return sorted((r.alert, r.window_start.minute, r.item, r.requests, r.batch_id) for r in changelog.collect())

    told = batch(("1.1.1.1", 1, 200, 4), ("2.2.2.2", 1, 404, 2))
    assert told == []
    told = batch(("1.1.1.1", 1, 200, 3), ("2.2.2.2", 2, 404, 5))
    first = told[0][-1]
    assert told == [("error_spikes", 0, "404", 7, first), ("suspicious_ips", 1, "1.1.1.1", 7, first), ("suspicious_ips", 2, "2.2.2.2", 5, first)]
    # Further requests beyond the limits are not told again.
    assert batch(("1.1.1.1", 1, 200, 9), ("2.2.2.2", 2, 404, 9)) == told
    # A later time closes those windows; what comes late neither is told again nor starts anew.
    assert batch(("3.3.3.3", 40, 200, 1)) == told
    assert batch(("1.1.1.1", 1, 200, 9), ("4.4.4.4", 1, 404, 9)) == told
    assert [t[:4] for t in batch(("3.3.3.3", 40, 500, 5)) if t not in told] == [("error_spikes", 40, "500", 5), ("suspicious_ips", 40, "3.3.3.3", 6)]


def test_append_mode_with_all_alerts_from_one_read(spark, tmp_path):
    line = '1.1.1.1 - - [10/Feb/2025:07:{:02d}:00 +0000] "GET /x HTTP/1.1" 404 5'
    _write(tmp_path / "in", [line.format(m) for m in (1, 2, 6, 30, 31, 3)], 6)
    logs = op.parse_stream_tokens(_stream(spark, tmp_path / "in"))
    results = op.all_alerts(logs, watermark="10 minutes")
    _run(results, tmp_path, mode="append")
    closed = read_changelog(spark, str(tmp_path / "out"), results.schema)
    assert _rows(closed.select("alert", "window_start", "item", "requests")) == [
        ("error_spikes", datetime(2025, 2, 10, 7, 0), "404", 2), ("error_spikes", datetime(2025, 2, 10, 7, 5), "404", 1)]
