"""Streaming queries: sinks that survive replay, named queries, waiting."""

from hitscope.streaming.queries import ALERT_KEYS, ALL_ALERTS_KEYS, await_all, start_alerts, start_all_alerts, start_query
from hitscope.streaming.session import stream_session
from hitscope.streaming.sinks import append_batch, compact_changelog, print_batch, read_changelog

__all__ = [
    "ALERT_KEYS",
    "ALL_ALERTS_KEYS",
    "append_batch",
    "await_all",
    "compact_changelog",
    "print_batch",
    "read_changelog",
    "start_alerts",
    "start_all_alerts",
    "start_query",
    "stream_session",
]
