"""Alerts that are told once: a window's item is emitted when its count crosses the limit, and not again."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hitscope.operators.alerts import AlertRule, alert_rows

_KEYS = ["alert", "window_start", "window_end", "item"]
_OUTPUT = "alert STRING, window_start TIMESTAMP, window_end TIMESTAMP, item STRING, requests BIGINT"


class _Crossing(StatefulProcessor):
    """Requests of one window and item so far; a timer drops them when the window is over."""

    def __init__(self, limits: dict[str, int]):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("requests", "n BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        alert, _, end, _ = key
        before = self.seen.get()[0] if self.seen.exists() else 0
        if not before:
            self.handle.registerTimer(int(pd.Timestamp(end).timestamp() * 1000))
        now = before + int(sum(part["n"].sum() for part in rows))
        self.seen.update((now,))
        if before <= self.limits[alert] < now:
            yield pd.DataFrame([[*key, now]], columns=[*_KEYS, "requests"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def _combined(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a batch of rows, so that a hot item costs the shuffle one row for each batch."""
    for part in parts:
        yield part.groupby([*_KEYS, "until"], dropna=False, as_index=False).size().rename(columns={"size": "n"})


def alerts_once(logs: DataFrame, rules: list[AlertRule] | None = None, watermark: str = "10 minutes") -> DataFrame:
    """``alert, window_start, window_end, item, requests``: each window's item once, in the micro-batch in which it crosses its limit.

    ``requests`` is the count at the end of that micro-batch. ``all_alerts`` in update mode emits a row again
    with every change beyond the limit. A row counts as long as its window is not over by the
    watermark, then its state is dropped. For streams, in update or append mode, on a session whose state is in
    RocksDB (``stream_session``); a restart goes on from the checkpoint.
    """
    rows, rules = alert_rows(logs, rules)
    widest = max(rule.seconds for rule in rules)
    # The event time is the end of the window, which is ahead of the row by no more than the widest window.
    ends = rows.select(
        "alert",
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + F.col("seconds")).alias("window_end"),
        "item",
    ).withColumn("until", F.col("window_end"))
    schema = "alert STRING, window_start TIMESTAMP, window_end TIMESTAMP, item STRING, until TIMESTAMP, n BIGINT"
    counted = ends.mapInPandas(_combined, schema).withWatermark("until", f"{watermark} {widest} seconds")
    limits = {rule.alert: rule.more_than for rule in rules}
    return counted.groupBy(*_KEYS).transformWithStateInPandas(
        _Crossing(limits), outputStructType=_OUTPUT, outputMode="Update", timeMode="EventTime"
    )
