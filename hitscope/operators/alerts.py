"""Alerts and running counts; one definition serves batch and stream.

Input is the output of a stream parser. Windows are tumbling, in event time,
aligned to the epoch; rows without a time are in none. ``watermark`` is the
lateness to allow for. Without one a stream accepts rows however late, keeps
every window in its state for good, and cannot run in append mode.
"""

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from hitscope.fixed_values import (
    SPIKE_STATUSES,
    SPIKE_WINDOW,
    SUSPICIOUS_MORE_THAN,
    SUSPICIOUS_WINDOW,
    TRENDING_MARKER,
    TRENDING_MORE_THAN,
    TRENDING_WINDOW,
)


def _count_in_windows(
    logs: DataFrame, key: str, width: str, watermark: str | None, having: Column | None = None
) -> DataFrame:
    if watermark is not None:
        logs = logs.withWatermark("ts", watermark)
    counts = logs.groupBy(F.window("ts", width), key).agg(F.count("*").alias("requests"))
    if having is not None:
        counts = counts.where(having)
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        "requests",
    )


def error_spikes(
    logs: DataFrame,
    statuses: Sequence[int] = tuple(SPIKE_STATUSES),
    width: str = SPIKE_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Requests per window and status, for the statuses to watch."""
    return _count_in_windows(logs.where(F.col("status").isin(list(statuses))), "status", width, watermark)


def trending_products(
    logs: DataFrame,
    more_than: int = TRENDING_MORE_THAN,
    marker: str = TRENDING_MARKER,
    width: str = TRENDING_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Product urls asked for more than ``more_than`` times in a window."""
    products = logs.where(F.col("url").contains(marker))
    return _count_in_windows(products, "url", width, watermark, F.col("requests") > more_than)


def suspicious_ips(
    logs: DataFrame,
    more_than: int = SUSPICIOUS_MORE_THAN,
    width: str = SUSPICIOUS_WINDOW,
    watermark: str | None = None,
) -> DataFrame:
    """Addresses with more than ``more_than`` requests in a window."""
    return _count_in_windows(logs, "ip", width, watermark, F.col("requests") > more_than)


# Seconds in a unit of a window's width.
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _seconds(width: str) -> int:
    count, unit = width.split()
    return int(count) * _UNITS[unit.lower().removesuffix("s")]


class AlertRule(NamedTuple):
    """Rows for which a condition holds, counted by item in windows; told where the count is beyond a limit."""

    alert: str
    condition: Column
    item: str
    seconds: int
    more_than: int


def alert_rules(
    statuses: Sequence[int] = tuple(SPIKE_STATUSES),
    marker: str = TRENDING_MARKER,
    trending_more_than: int = TRENDING_MORE_THAN,
    suspicious_more_than: int = SUSPICIOUS_MORE_THAN,
    spike_width: str = SPIKE_WINDOW,
    trending_width: str = TRENDING_WINDOW,
    suspicious_width: str = SUSPICIOUS_WINDOW,
    spike_more_than: int = 0,
) -> list[AlertRule]:
    """The three alerts."""
    return [
        AlertRule("error_spikes", F.col("status").isin(list(statuses)), "status", _seconds(spike_width), spike_more_than),
        AlertRule("trending_products", F.col("url").contains(marker), "url", _seconds(trending_width), trending_more_than),
        AlertRule("suspicious_ips", F.lit(True), "ip", _seconds(suspicious_width), suspicious_more_than),
    ]


def alert_rows(logs: DataFrame, rules: list[AlertRule] | None = None) -> tuple[DataFrame, list[AlertRule]]:
    """``ts, alert, start, seconds, item``, a row for each alert that a log row counts for, and the rules."""
    rules = rules or alert_rules()
    second = F.unix_seconds("ts")
    counted = F.array(*[
        F.when(
            rule.condition,
            F.struct(
                F.lit(rule.alert).alias("alert"),
                (second - F.pmod(second, F.lit(rule.seconds))).alias("start"),
                F.lit(rule.seconds).alias("seconds"),
                F.col(rule.item).cast("string").alias("item"),
            ),
        )
        for rule in rules
    ])
    rows = F.inline(F.filter(counted, lambda row: row.isNotNull()))
    return logs.where(F.col("ts").isNotNull()).select("ts", rows), rules


def all_alerts(logs: DataFrame, rules: list[AlertRule] | None = None, watermark: str | None = None) -> DataFrame:
    """The three alerts as rows ``alert, window_start, window_end, item, requests``, from one read and one state.

    Every log row gives a row for each alert that it counts for, and one
    aggregate counts all of them by (alert, window, item); limits come after it. On a
    stream that is one source reader and one state store in place of three.
    The aggregate's own window is the shortest that all widths divide, so with a watermark the
    state of a shorter window lives until that one is over, and in append mode
    its rows come then.
    """
    if watermark is not None:
        logs = logs.withWatermark("ts", watermark)
    rows, rules = alert_rows(logs, rules)
    outer = f"{math.lcm(*[rule.seconds for rule in rules])} seconds"
    counts = rows.groupBy(F.window("ts", outer), "alert", "start", "seconds", "item").agg(F.count("*").alias("requests"))
    limit = F.coalesce(*[F.when(F.col("alert") == rule.alert, F.lit(rule.more_than)) for rule in rules])
    return counts.where(F.col("requests") > limit).select(
        "alert",
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + F.col("seconds")).alias("window_end"),
        "item",
        "requests",
    )


def status_counts(logs: DataFrame) -> DataFrame:
    """Requests per status over all time; messages without one count under NULL."""
    return logs.groupBy("status").agg(F.count("*").alias("requests"))
