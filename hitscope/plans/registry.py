"""Every operator as a query on the given tables.

Instants leave as UTC wall-clock time, so that results do not depend on the
session time zone.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitscope import operators as op
from hitscope.functions import two_decimals, utc_wall_clock
from hitscope.plans.inputs import LATE_EVERY, LATENESS, PART_DAYS, events_path, log_line_stream, log_lines, with_log_line
from hitscope.plans.programs import one_read_program, report_at_once
from hitscope.plans.shared import shared_path
from hitscope.sources import (
    decode_messages,
    read_kv_text,
    read_log_lines,
    read_log_stream,
    sorted_pairs,
    write_kv_text,
)
from hitscope.streaming import (
    ALERT_KEYS,
    ALL_ALERTS_KEYS,
    append_batch,
    await_all,
    compact_changelog,
    read_changelog,
    start_alerts,
    start_all_alerts,
    start_query,
    stream_session,
)

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(result: DataFrame) -> DataFrame:
    instants = [f.name for f in result.schema if f.dataType.typeName() == "timestamp"]
    return result.withColumns({name: utc_wall_clock(F.col(name)) for name in instants})


def _parsed(parser: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: _in_utc(parser(log_lines(spark, sf_dir), ["event_id"]))


def _analysed(analysis: Callable[[DataFrame], DataFrame], parser=op.parse_access_log) -> Query:
    if analysis in op.COLUMNS:
        return lambda spark, sf_dir: op.analyse(log_lines(spark, sf_dir), analysis, parser)
    return lambda spark, sf_dir: analysis(parser(log_lines(spark, sf_dir)))


def _alert(alert: Callable[[DataFrame], DataFrame], burst: bool) -> Query:
    return lambda spark, sf_dir: _in_utc(alert(op.parse_stream_tokens(log_lines(spark, sf_dir, burst))))


def _streamed(
    query: Callable[[DataFrame], DataFrame], keys: tuple[str, ...], burst: bool, parser=op.parse_stream_tokens
) -> Query:
    """Run the query on a stream up to the end of the input, then fold what it emitted."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = log_line_stream(stream_session(spark), sf_dir, burst)
        results = query(parser(decode_messages(messages)))
        root = shared_path(spark, query.__name__)
        running = start_query(
            results,
            name=f"{query.__name__}-{uuid4().hex}",
            checkpoint=f"{root}/checkpoint",
            sink=append_batch(path=f"{root}/changelog"),
            trigger={"availableNow": True},
        )
        await_all([running])
        changelog = read_changelog(spark, f"{root}/changelog", results.schema, missing_ok=True)
        return _in_utc(op.latest_counts(changelog, keys))

    return run


def _arriving(spark: SparkSession, sf_dir: str, root: str, batches: int = 4) -> DataFrame:
    """A burst of the log as a text source that arrives in *batches* micro-batches."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Events are dealt out, not lines: they are shorter, and lines are made by as many tasks however few the table has.
    events = spark.read.parquet(events_path(sf_dir)).repartition(batches * width, "event_id")
    with_log_line(events, burst=True).select("value").write.text(f"{root}/log")
    return read_log_stream(stream_session(spark), "text", {"path": f"{root}/log", "maxFilesPerTrigger": str(width)})


def _alerts_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three alerts in one session on a log that arrives in several micro-batches, folded."""
    root = shared_path(spark, "alerts")
    logs = op.parse_stream_tokens(_arriving(spark, sf_dir, root))
    sink_of = lambda name: append_batch(path=f"{root}/{name}")
    await_all(start_alerts(logs, f"{root}/checkpoints", sink_of, trigger={"availableNow": True}))

    def folded(name: str) -> DataFrame:
        changelog = read_changelog(spark, f"{root}/{name}", getattr(op, name)(logs).schema, missing_ok=True)
        *window, item = ALERT_KEYS[name]
        latest = op.latest_counts(changelog, ALERT_KEYS[name])
        return latest.select(F.lit(name).alias("alert"), *window, F.col(item).cast("string").alias("item"), "requests")

    spikes, trending, suspicious = map(folded, ALERT_KEYS)
    return _in_utc(spikes.union(trending).union(suspicious))


def _alerts_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one query: one read of the source and one state."""
    root = shared_path(spark, "alerts")
    logs = op.parse_stream_tokens(_arriving(spark, sf_dir, root))
    sink = append_batch(path=f"{root}/changelog")
    await_all([start_all_alerts(logs, f"{root}/checkpoints", sink, trigger={"availableNow": True})])
    changelog = read_changelog(spark, f"{root}/changelog", op.all_alerts(logs).schema, missing_ok=True)
    return _in_utc(op.latest_counts(changelog, ALL_ALERTS_KEYS))


def _compacted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per status of several micro-batches, folded twice on the way to the result."""
    root = shared_path(spark, "compacted")
    counts = op.status_counts(op.parse_stream_regex(_arriving(spark, sf_dir, root)))
    query = start_query(
        counts, f"status-{uuid4().hex}", f"{root}/checkpoint", append_batch(path=f"{root}/changelog"), trigger={"availableNow": True}
    )
    await_all([query])
    for up_to in (0, None):
        compact_changelog(spark, f"{root}/changelog", ["status"], counts.schema, up_to)
    return op.latest_counts(read_changelog(spark, f"{root}/changelog", counts.schema), ["status"])


def _watermarked_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error spikes in append mode, with a watermark, on a log of which every seventh line comes ten days late.

    Each of the five parts of the log is one run of the query, so the order of the batches is fixed: windows leave when they
    close, and lines that come after that are dropped.
    """
    root = shared_path(spark, "watermarked")
    part = f"(day(ts) div {PART_DAYS} + CASE WHEN event_id % {LATE_EVERY} = 0 THEN 1 ELSE 0 END)"
    events = spark.read.parquet(events_path(sf_dir))
    for number in range(5):
        dealt = events.where(F.expr(part) == number).repartition("event_id")
        with_log_line(dealt).select("value").write.mode("append").text(f"{root}/log")
        arriving = read_log_stream(stream_session(spark), "text", {"path": f"{root}/log"})
        spikes = op.error_spikes(op.parse_stream_tokens(arriving), watermark=LATENESS)
        query = start_query(
            spikes, f"spikes-{uuid4().hex}", f"{root}/checkpoint", append_batch(path=f"{root}/closed"), "append", {"availableNow": True}
        )
        await_all([query])
    return _in_utc(read_changelog(spark, f"{root}/closed", spikes.schema, missing_ok=True).drop("batch_id"))


def _scan_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "log")
    log_lines(spark, sf_dir).select("value").write.text(path)
    return read_log_lines(spark, path)


def _avg_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = op.analyse(log_lines(spark, sf_dir), op.avg_size_by_category, op.parse_access_log)
    return means.select("category", two_decimals(F.col("avg_response_size")).alias("avg_size_text"))


def _one_read(report: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        logs = op.parse_access_log(log_lines(spark, sf_dir))
        return one_read_program(logs, shared_path(spark, "rollup"))[report]

    return run


def _at_once(line_format: str, report: str) -> Query:
    """A report of a format's program, all of which come from one read."""
    return lambda spark, sf_dir: report_at_once(log_lines(spark, sf_dir), line_format, shared_path(spark, "report"))[report]


def _kv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "key-value")
    pairs = spark.read.parquet(events_path(sf_dir)).selectExpr(
        "CAST(user_id AS INT) AS k",
        "CASE WHEN event_type = 'view' THEN '' ELSE event_type || '\t' || event_id END AS v",
    )
    write_kv_text(pairs, path)
    return sorted_pairs(read_kv_text(spark, path))


QUERIES: dict[str, Query] = {
    # Sources.
    "scan_log_lines": _scan_log_lines,
    "kv_text_roundtrip": _kv_text_roundtrip,
    # Parsers.
    "parse_access_log": _parsed(op.parse_access_log),
    "parse_extended_log": _parsed(op.parse_extended_log),
    "parse_basic_log": _parsed(op.parse_basic_log),
    "parse_stream_tokens": _parsed(op.parse_stream_tokens),
    "parse_stream_regex": _parsed(op.parse_stream_regex),
    "malformed_lines": lambda spark, sf_dir: op.malformed_lines(log_lines(spark, sf_dir)),
    # Previews.
    "preview_lines": lambda spark, sf_dir: op.preview(log_lines(spark, sf_dir), order_by=["event_id"]),
    "preview_parsed": lambda spark, sf_dir: op.preview(
        op.parse_basic_log(log_lines(spark, sf_dir), ["event_id"]), order_by=["event_id"]
    ),
    # Batch analyses.
    "product_views": _analysed(op.product_views),
    "top_products": _analysed(op.top_products, op.parse_extended_log),
    "status_distribution": _analysed(op.status_distribution),
    "requests_by_ip": _analysed(op.requests_by_ip),
    "top_ips": _analysed(op.top_ips),
    "most_active_ip": _analysed(op.most_active_ip, op.parse_basic_log),
    "avg_size_by_category": _analysed(op.avg_size_by_category),
    "avg_size_by_path_category": _analysed(op.avg_size_by_category, op.parse_extended_log),
    "avg_size_report": _avg_size_report,
    "total_requests": _analysed(op.total_requests),
    "method_distribution": _analysed(op.method_distribution),
    "requests_by_url": _analysed(op.requests_by_url, op.parse_basic_log),
    "top_urls": _analysed(op.top_urls, op.parse_basic_log),
    "least_urls": _analysed(op.least_urls, op.parse_basic_log),
    "response_sizes": _analysed(op.response_sizes, op.parse_basic_log),
    "avg_response_size": _analysed(op.avg_response_size, op.parse_basic_log),
    "error_urls": _analysed(op.error_urls),
    # All counting reports from one read.
    "traffic_rollup": _analysed(op.traffic_rollup),
    "one_read_top_urls": _one_read("top_urls"),
    "one_read_product_views": _one_read("product_views"),
    "one_read_status_distribution": _one_read("status_distribution"),
    "one_read_top_ips": _one_read("top_ips"),
    "one_read_avg_size_by_category": _one_read("avg_size_by_category"),
    "one_read_total_requests": _one_read("total_requests"),
    "one_read_avg_response_size": _one_read("avg_response_size"),
    "one_read_method_distribution": _one_read("method_distribution"),
    "one_read_least_urls": _one_read("least_urls"),
    "at_once_error_urls": _at_once("current", "error_urls"),
    "at_once_top_products": _at_once("extended", "top_products"),
    "at_once_most_active_ip": _at_once("basic", "most_active_ip"),
    # Alerts on a table.
    "status_counts": _analysed(op.status_counts, op.parse_stream_regex),
    "error_spikes": _alert(op.error_spikes, burst=False),
    "trending_products": _alert(op.trending_products, burst=True),
    "suspicious_ips": _alert(op.suspicious_ips, burst=True),
    # The same on a stream.
    "stream_status_counts": _streamed(op.status_counts, ("status",), False, op.parse_stream_regex),
    "stream_error_spikes": _streamed(op.error_spikes, ALERT_KEYS["error_spikes"], False),
    "stream_trending_products": _streamed(op.trending_products, ALERT_KEYS["trending_products"], True),
    "stream_suspicious_ips": _streamed(op.suspicious_ips, ALERT_KEYS["suspicious_ips"], True),
    "stream_alerts_together": _alerts_together,
    "stream_alerts_one_read": _alerts_one_read,
    "stream_watermarked_spikes": _watermarked_spikes,
    "stream_compacted_counts": _compacted_counts,
}
