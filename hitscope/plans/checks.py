"""The registered queries in SQL, for the engine that checks the results.

Written from the plain line patterns, with that engine's own functions.
"""

from hitscope.fixed_values import (
    BASIC_PATTERN,
    CATEGORY_PATH_PATTERN,
    CURRENT_PATTERN,
    EXTENDED_PATTERN,
    OTHER_CATEGORY,
    OTHER_STATUS,
    PRODUCT_CATEGORIES,
    PRODUCT_PATH_PATTERN,
    PRODUCT_QUERY_PATTERN,
    PRODUCT_RANGE_END,
    PRODUCT_RANGE_START,
    STATUS_LABELS,
    STREAM_METHOD_PATTERN,
    STREAM_PROTOCOL_PATTERN,
    STREAM_TIME_PATTERN,
    STREAM_URL_PATTERN,
    UNKNOWN_PATH_CATEGORY,
)
from hitscope.plans.inputs import LATE_EVERY, LATENESS, PART_DAYS, line_sql

_TIME_FORM = "%d/%b/%Y:%H:%M:%S"

_CATEGORY = (
    "CASE "
    + " ".join(
        f"WHEN {' OR '.join(f"contains(url, '{word}')" for word in words)} THEN '{name}'"
        for name, words in PRODUCT_CATEGORIES.items()
    )
    + f" ELSE '{OTHER_CATEGORY}' END"
)
_LABEL = (
    "CASE status "
    + " ".join(f"WHEN {code} THEN '{text}'" for code, text in STATUS_LABELS.items())
    + f" ELSE '{OTHER_STATUS}' END"
)


def _utc(text: str) -> str:
    """Wall-clock time in UTC; the lines made from events have an offset of +0000 or none."""
    return f"try_strptime(replace(trim({text}), ' +0000', ''), '{_TIME_FORM}')"


def _parsed(pattern: str, product_id: str, category: str) -> str:
    group = lambda i: f"regexp_extract(value, '^{pattern}', {i})"
    return f"""
    WITH lines AS ({line_sql()}),
    fields AS (
      SELECT event_id, {group(1)} AS ip, {group(2)} AS timestamp_text, {group(3)} AS method, {group(4)} AS url,
        TRY_CAST({group(5)} AS BIGINT) AS status, TRY_CAST({group(6)} AS BIGINT) AS response_size
      FROM lines WHERE regexp_matches(value, '^{pattern}')),
    logs AS (
      SELECT *, {_utc('timestamp_text')} AS ts, {product_id} AS product_id, {category} AS category FROM fields)
    """


def _product(pattern: str) -> str:
    return f"nullif(regexp_extract(url, '{pattern}', 1), '')"


_CURRENT = _parsed(CURRENT_PATTERN, _product(PRODUCT_QUERY_PATTERN), _CATEGORY)
_EXTENDED = _parsed(
    EXTENDED_PATTERN,
    _product(PRODUCT_PATH_PATTERN),
    f"coalesce(nullif(regexp_extract(url, '{CATEGORY_PATH_PATTERN}', 1), ''), '{UNKNOWN_PATH_CATEGORY}')",
)
_BASIC = _parsed(BASIC_PATTERN, "NULL", "NULL")

_LOG_COLUMNS = "event_id, ip, ts, method, url, status, response_size, product_id, category"
_BASIC_COLUMNS = "event_id, ip, timestamp_text, method, url, status, response_size"


def _regex(burst: bool = False) -> str:
    return f"""
    WITH lines AS ({line_sql(burst)}),
    logs AS (
      SELECT event_id, string_split(value, ' ')[1] AS ip,
        regexp_extract(value, '{STREAM_TIME_PATTERN}', 1) AS timestamp_text,
        regexp_extract(value, '{STREAM_METHOD_PATTERN}', 1) AS method,
        regexp_extract(value, '{STREAM_URL_PATTERN}', 1) AS url,
        regexp_extract(value, '{STREAM_PROTOCOL_PATTERN}', 0) AS protocol,
        TRY_CAST(string_split(value, ' ')[9] AS INTEGER) AS status,
        TRY_CAST(string_split(value, ' ')[10] AS INTEGER) AS size
      FROM lines)
    """


def _tokens(burst: bool) -> str:
    token = lambda i: f"string_split(value, ' ')[{i + 1}]"
    time_text = f"ltrim({token(3)}, '[') || ' ' || rtrim(coalesce({token(4)}, ''), ']')"
    return f"""
    WITH lines AS ({line_sql(burst)}),
    logs AS (
      SELECT event_id, {token(0)} AS ip, {_utc(time_text)} AS ts, ltrim({token(5)}, '"') AS method,
        {token(6)} AS url, TRY_CAST({token(8)} AS INTEGER) AS status
      FROM lines)
    """


_REGEX = _regex()


def _count(logs: str, key: str, name: str = "requests", where: str = "true", rest: str = "") -> str:
    return f"{logs} SELECT {key}, count(*) AS {name} FROM logs WHERE {where} GROUP BY {key} {rest}"


def _windows(burst: bool, key: str, width: str, where: str = "true", having: str = "true") -> str:
    start = f"time_bucket(INTERVAL '{width}', ts)"
    return f"""{_tokens(burst)}
    SELECT {start} AS window_start, {start} + INTERVAL '{width}' AS window_end, {key}, count(*) AS requests
    FROM logs WHERE ts IS NOT NULL AND {where} GROUP BY {start}, {key} HAVING {having}"""


_SIZE_MEAN = "sum(response_size) / count(response_size)"
_MOST_URLS = _count(_BASIC, "url", rest="ORDER BY requests DESC, url LIMIT 5")
_STATUS_COUNTS = _count(_REGEX, "status")
_SPIKES = _windows(False, "status", "5 minutes", "status IN (404, 500)")
_TRENDING = _windows(True, "url", "1 minute", "contains(url, '/products/')", "count(*) > 20")
_SUSPICIOUS = _windows(True, "ip", "1 minute", having="count(*) > 100")

_ROLLUP = f"{_CURRENT} " + " UNION ALL ".join(
    f"SELECT '{dimension}' AS dimension, CAST({item} AS VARCHAR) AS item, count(*) AS requests,"
    f" {_SIZE_MEAN} AS avg_response_size FROM logs WHERE {where} GROUP BY {item}"
    for dimension, item, where in [
        ("product_id", "product_id", "product_id IS NOT NULL"),
        *[(key, key, "true") for key in ("status", "ip", "category", "method", "url")],
    ]
) + f" UNION ALL SELECT 'total', NULL, count(*), {_SIZE_MEAN} FROM logs"

_TOGETHER = " UNION ALL ".join(
    f"SELECT '{alert}' AS alert, window_start, window_end, CAST({item} AS VARCHAR) AS item, requests FROM ({sql})"
    for alert, item, sql in [
        ("error_spikes", "status", _windows(True, "status", "5 minutes", "status IN (404, 500)")),
        ("trending_products", "url", _TRENDING),
        ("suspicious_ips", "ip", _SUSPICIOUS),
    ]
)

_TOP_PRODUCTS = _count(
    _EXTENDED,
    "product_id",
    "views",
    "product_id IS NOT NULL"
    f" AND ts BETWEEN TIMESTAMP '{PRODUCT_RANGE_START}' AND TIMESTAMP '{PRODUCT_RANGE_END}'",
    "ORDER BY views DESC, product_id LIMIT 10",
)
_ERROR_URLS = f"""{_CURRENT} SELECT url, status, category FROM logs WHERE status >= 400
        ORDER BY ts NULLS LAST, url, status, event_id LIMIT 10"""
# A line of a window that was over, by the latest time of the parts before and the lateness allowed, is lost;
# windows that are not over at the end stay in the state.
_WATERMARKED = f"""{_tokens(False)},
    spikes AS (
      SELECT l.ts, l.status, day(e.ts) // {PART_DAYS} + CASE WHEN event_id % {LATE_EVERY} = 0 THEN 1 ELSE 0 END AS part,
        time_bucket(INTERVAL '5 minutes', l.ts) AS window_start
      FROM logs l JOIN events e USING (event_id) WHERE l.ts IS NOT NULL AND l.status IN (404, 500)),
    parts AS (SELECT part, max(ts) AS latest FROM spikes GROUP BY part),
    marks AS (SELECT part, max(latest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM parts)
    SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, status, count(*) AS requests
    FROM spikes JOIN marks USING (part)
    WHERE before IS NULL OR window_start + INTERVAL '5 minutes' > before - INTERVAL '{LATENESS}'
    GROUP BY window_start, status
    HAVING window_start + INTERVAL '5 minutes' <= (SELECT max(ts) FROM spikes) - INTERVAL '{LATENESS}'"""

ORACLE_SQL: dict[str, str] = {
    "scan_log_lines": f"SELECT value FROM ({line_sql()})",
    "kv_text_roundtrip": """
        SELECT CAST(user_id AS INTEGER) AS k,
          CASE WHEN event_type = 'view' THEN '' ELSE event_type || chr(9) || event_id END AS v
        FROM events ORDER BY k, v""",
    "parse_access_log": f"{_CURRENT} SELECT {_LOG_COLUMNS} FROM logs",
    "parse_extended_log": f"{_EXTENDED} SELECT {_LOG_COLUMNS} FROM logs",
    "parse_basic_log": f"{_BASIC} SELECT {_BASIC_COLUMNS} FROM logs",
    "parse_stream_tokens": f"{_tokens(False)} SELECT * FROM logs",
    "parse_stream_regex": f"{_REGEX} SELECT * FROM logs",
    "malformed_lines": f"SELECT * FROM ({line_sql()}) WHERE NOT regexp_matches(value, '^{CURRENT_PATTERN}')",
    "preview_lines": f"SELECT * FROM ({line_sql()}) ORDER BY event_id LIMIT 10",
    "preview_parsed": f"{_BASIC} SELECT {_BASIC_COLUMNS} FROM logs ORDER BY event_id LIMIT 10",
    "product_views": _count(_CURRENT, "product_id", "views", "product_id IS NOT NULL"),
    "top_products": _TOP_PRODUCTS,
    "status_distribution":
        f"{_CURRENT} SELECT status, {_LABEL} AS label, count(*) AS requests FROM logs GROUP BY status",
    "requests_by_ip": _count(_CURRENT, "ip"),
    "top_ips": _count(_CURRENT, "ip", rest="ORDER BY requests DESC, ip LIMIT 10"),
    "most_active_ip": _count(_BASIC, "ip", rest="ORDER BY requests DESC, ip LIMIT 1"),
    "avg_size_by_category":
        f"{_CURRENT} SELECT category, {_SIZE_MEAN} AS avg_response_size FROM logs GROUP BY category",
    "avg_size_by_path_category":
        f"{_EXTENDED} SELECT category, {_SIZE_MEAN} AS avg_response_size FROM logs GROUP BY category",
    "avg_size_report":
        f"{_CURRENT} SELECT category, printf('%.2f', {_SIZE_MEAN}) AS avg_size_text FROM logs GROUP BY category",
    "total_requests": f"{_CURRENT} SELECT count(*) AS requests FROM logs",
    "method_distribution": _count(_CURRENT, "method"),
    "requests_by_url": _count(_BASIC, "url"),
    "top_urls": _MOST_URLS,
    "least_urls": _count(_BASIC, "url", rest="ORDER BY requests, url LIMIT 3"),
    "response_sizes": f"{_BASIC} SELECT response_size FROM logs",
    "avg_response_size": f"{_BASIC} SELECT {_SIZE_MEAN} AS avg_response_size FROM logs",
    "error_urls": _ERROR_URLS,
    "traffic_rollup": _ROLLUP,
    "one_read_top_urls": _count(_CURRENT, "url", rest="ORDER BY requests DESC, url LIMIT 5"),
    "one_read_product_views": _count(_CURRENT, "product_id", "views", "product_id IS NOT NULL"),
    "one_read_status_distribution":
        f"{_CURRENT} SELECT status, {_LABEL} AS label, count(*) AS requests FROM logs GROUP BY status",
    "one_read_top_ips": _count(_CURRENT, "ip", rest="ORDER BY requests DESC, ip LIMIT 10"),
    "one_read_avg_size_by_category":
        f"{_CURRENT} SELECT category, {_SIZE_MEAN} AS avg_response_size FROM logs GROUP BY category",
    "one_read_total_requests": f"{_CURRENT} SELECT count(*) AS requests FROM logs",
    "one_read_avg_response_size": f"{_CURRENT} SELECT {_SIZE_MEAN} AS avg_response_size FROM logs",
    "one_read_method_distribution": _count(_CURRENT, "method"),
    "one_read_least_urls": _count(_CURRENT, "url", rest="ORDER BY requests, url LIMIT 3"),
    "at_once_error_urls": _ERROR_URLS,
    "at_once_top_products": _TOP_PRODUCTS,
    "at_once_most_active_ip": _count(_BASIC, "ip", rest="ORDER BY requests DESC, ip LIMIT 1"),
    "status_counts": _STATUS_COUNTS,
    "error_spikes": _SPIKES,
    "trending_products": _TRENDING,
    "suspicious_ips": _SUSPICIOUS,
    "stream_status_counts": _STATUS_COUNTS,
    "stream_error_spikes": _SPIKES,
    "stream_trending_products": _TRENDING,
    "stream_suspicious_ips": _SUSPICIOUS,
    "stream_alerts_together": _TOGETHER,
    "stream_alerts_one_read": _TOGETHER,
    "stream_watermarked_spikes": _WATERMARKED,
    "stream_compacted_counts": _count(_regex(burst=True), "status"),
}
