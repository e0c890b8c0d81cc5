from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hitscope.operators import all_alerts, error_spikes, suspicious_ips, trending_products
from hitscope.streaming.sinks import print_batch

Sink = str | Callable[[DataFrame, int], None]

#: Columns that identify a row of each alert, for ``latest_counts``.
ALERT_KEYS = {
    "error_spikes": ("window_start", "window_end", "status"),
    "trending_products": ("window_start", "window_end", "url"),
    "suspicious_ips": ("window_start", "window_end", "ip"),
}
#: The same for the rows of ``all_alerts``.
ALL_ALERTS_KEYS = ("alert", "window_start", "window_end", "item")


def start_query(
    results: DataFrame,
    name: str,
    checkpoint: str,
    sink: Sink = print_batch,
    mode: str = "update",
    trigger: Mapping[str, str | bool] | None = None,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start one named query with a checkpoint of its own.

    ``sink`` is a ``foreachBatch`` function such as ``append_batch`` makes or a
    format name (``memory``, ``kafka``; ``parquet`` in append mode; ``console``,
    which shows 20 rows of a batch where ``print_batch`` prints them all).
    ``trigger`` takes the arguments of ``DataStreamWriter.trigger``;
    ``{"availableNow": True}`` reads what is there and stops.
    """
    writer = (
        results.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_alerts(
    logs: DataFrame,
    checkpoint_root: str,
    sink_of: Callable[[str], Sink] = lambda name: print_batch,
    mode: str = "update",
    trigger: Mapping[str, str | bool] | None = None,
    watermark: str | None = None,
) -> list[StreamingQuery]:
    """Start the three alerts on a parsed stream, as independent queries.

    ``sink_of`` maps the name of an alert to its sink.
    """
    alerts = {
        "error_spikes": error_spikes(logs, watermark=watermark),
        "trending_products": trending_products(logs, watermark=watermark),
        "suspicious_ips": suspicious_ips(logs, watermark=watermark),
    }
    return [
        start_query(
            results,
            name,
            f"{checkpoint_root.rstrip('/')}/{name}",
            sink_of(name),
            mode,
            trigger,
        )
        for name, results in alerts.items()
    ]


def start_all_alerts(
    logs: DataFrame,
    checkpoint_root: str,
    sink: Sink = print_batch,
    mode: str = "update",
    trigger: Mapping[str, str | bool] | None = None,
    watermark: str | None = None,
) -> StreamingQuery:
    """Start the three alerts on a parsed stream as one query with one reader and one state."""
    checkpoint = f"{checkpoint_root.rstrip('/')}/all_alerts"
    return start_query(all_alerts(logs, watermark=watermark), "all_alerts", checkpoint, sink, mode, trigger)


def await_all(queries: Sequence[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until every query ends; raise as soon as any of them fails.

    The others go on then, and are the caller's to stop or to wait for again.
    """
    running = list(queries)
    while running:
        running = [q for q in running if not q.awaitTermination(poll_seconds)]
