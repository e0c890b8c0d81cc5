"""DataFrame operators: parsers, batch analyses and alerts."""

from hitscope.operators.alerts import alert_rules, all_alerts, error_spikes, status_counts, suspicious_ips, trending_products
from hitscope.operators.analyses import (
    COLUMNS,
    analyse,
    avg_response_size,
    avg_size_by_category,
    error_urls,
    least_urls,
    method_distribution,
    most_active_ip,
    preview,
    product_views,
    requests_by_ip,
    requests_by_url,
    response_sizes,
    status_distribution,
    top_ips,
    top_products,
    top_urls,
    total_requests,
)
from hitscope.operators.changelog import latest_counts
from hitscope.operators.parsing import (
    LOG_SCHEMA,
    PARSED_SCHEMA,
    malformed_lines,
    parse_access_log,
    parse_basic_log,
    parse_extended_log,
    parse_stream_regex,
    parse_stream_tokens,
)
from hitscope.operators.rollup import traffic_rollup

__all__ = [
    "COLUMNS",
    "LOG_SCHEMA",
    "PARSED_SCHEMA",
    "alert_rules",
    "all_alerts",
    "analyse",
    "avg_response_size",
    "avg_size_by_category",
    "error_spikes",
    "error_urls",
    "latest_counts",
    "least_urls",
    "malformed_lines",
    "method_distribution",
    "most_active_ip",
    "parse_access_log",
    "parse_basic_log",
    "parse_extended_log",
    "parse_stream_regex",
    "parse_stream_tokens",
    "preview",
    "product_views",
    "requests_by_ip",
    "requests_by_url",
    "response_sizes",
    "status_counts",
    "status_distribution",
    "suspicious_ips",
    "top_ips",
    "top_products",
    "top_urls",
    "total_requests",
    "traffic_rollup",
    "trending_products",
]
