"""Lines of the streamed logs are made by as many tasks as there are cores, however few row groups the events have."""

import pytest

from hitscope.plans import registry


@pytest.mark.parametrize("query", ["stream_alerts_together", "stream_watermarked_spikes"])
def test_events_are_dealt_out_before_lines_are_made(spark, tmp_path, monkeypatch, query):
    events = spark.sql(
        "SELECT id AS event_id, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT)) AS ts,"
        " id % 40 AS user_id, CASE WHEN id % 3 = 0 THEN 'error' ELSE 'view' END AS event_type FROM range(600)"
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    made, real = [], registry.with_log_line
    monkeypatch.setattr(registry, "with_log_line", lambda events, **more: made.append(events) or real(events, **more))
    rows = registry.QUERIES[query](spark, str(tmp_path))
    assert made and all("RepartitionByExpression" in e._jdf.queryExecution().analyzed().nodeName() for e in made)
    assert rows.count() > 0
