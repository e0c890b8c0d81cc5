"""Batch analyses: a parsed log in, a small or grouped result out.

Counts and means combine on the map side, so a key that holds a third of the
log leaves each task as one row. Lists of the first or last ``n`` rank with the
key as second order, which fixes ties, and plan as a bounded heap per task.
Only the parsed columns an analysis names are computed.
"""

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from hitscope.fixed_values import (
    ERROR_URLS,
    FIRST_ERROR_STATUS,
    LEAST_URLS,
    PREVIEW_ROWS,
    PRODUCT_RANGE_END,
    PRODUCT_RANGE_START,
    STATUS_LABELS,
    TOP_IPS,
    TOP_PRODUCTS,
    TOP_URLS,
)
from hitscope.functions import as_utc_timestamp, exact_mean, status_label


def _count_by(logs: DataFrame, key: str, name: str = "requests") -> DataFrame:
    return logs.groupBy(key).agg(F.count("*").alias(name))


def _most(counts: DataFrame, n: int) -> DataFrame:
    key, count = counts.columns
    return counts.orderBy(F.desc(count), key).limit(n)


def product_views(logs: DataFrame) -> DataFrame:
    """Views of each product that a url names."""
    return _count_by(logs.where(F.col("product_id").isNotNull()), "product_id", "views")


def top_products(
    logs: DataFrame,
    start: datetime | str = PRODUCT_RANGE_START,
    end: datetime | str = PRODUCT_RANGE_END,
    n: int = TOP_PRODUCTS,
) -> DataFrame:
    """Most viewed products between two instants, both included (UTC unless given an offset)."""
    in_range = F.col("ts").between(as_utc_timestamp(start), as_utc_timestamp(end))
    # Products first, so that the time is parsed for their lines only; inline
    # keeps it from being parsed once for each end of the range.
    products = logs.where(F.col("product_id").isNotNull()).select(
        "product_id", F.inline(F.array(F.struct("ts")))
    )
    return _most(_count_by(products.where(in_range), "product_id", "views"), n)


def status_distribution(logs: DataFrame, labels: Mapping[int, str] = STATUS_LABELS) -> DataFrame:
    """Requests per status with a readable label."""
    counts = _count_by(logs, "status")
    return counts.select("status", status_label(F.col("status"), labels).alias("label"), "requests")


def requests_by_ip(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "ip")


def top_ips(logs: DataFrame, n: int = TOP_IPS) -> DataFrame:
    return _most(requests_by_ip(logs), n)


def most_active_ip(logs: DataFrame) -> DataFrame:
    return top_ips(logs, 1)


def avg_size_by_category(logs: DataFrame) -> DataFrame:
    """Mean response size per category, of whichever kind the parser derived."""
    return logs.groupBy("category").agg(exact_mean(F.col("response_size")).alias("avg_response_size"))


def total_requests(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count("*").alias("requests"))


def method_distribution(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "method")


def requests_by_url(logs: DataFrame) -> DataFrame:
    return _count_by(logs, "url")


def top_urls(logs: DataFrame, n: int = TOP_URLS) -> DataFrame:
    return _most(requests_by_url(logs), n)


def least_urls(logs: DataFrame, n: int = LEAST_URLS) -> DataFrame:
    return requests_by_url(logs).orderBy("requests", "url").limit(n)


def response_sizes(logs: DataFrame) -> DataFrame:
    return logs.select("response_size")


def avg_response_size(logs: DataFrame) -> DataFrame:
    """Mean response size of all requests, NULL when there are none."""
    return response_sizes(logs).agg(exact_mean(F.col("response_size")).alias("avg_response_size"))


def error_urls(logs: DataFrame, n: int = ERROR_URLS) -> DataFrame:
    """First ``n`` requests that failed, with status and category.

    A status of a parsed line is NULL only where it has more digits than a BIGINT,
    so it counts as failed. Rows that tie on the order are equal in the result, so it is fixed.
    """
    return (
        logs.where(F.coalesce(F.col("status") >= FIRST_ERROR_STATUS, F.lit(True)))
        .orderBy(F.asc_nulls_last("ts"), "url", "status")
        .limit(n)
        .select("url", "status", "category")
    )


def preview(rows: DataFrame, n: int = PREVIEW_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows in the given order, or any ``n`` of the first partitions without one."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)


#: Columns of a parsed log that an analysis reads, for a parser's ``columns``.
COLUMNS = {
    product_views: ("product_id",),
    top_products: ("product_id", "ts"),
    status_distribution: ("status",),
    requests_by_ip: ("ip",),
    top_ips: ("ip",),
    most_active_ip: ("ip",),
    avg_size_by_category: ("category", "response_size"),
    total_requests: (),
    method_distribution: ("method",),
    requests_by_url: ("url",),
    top_urls: ("url",),
    least_urls: ("url",),
    response_sizes: ("response_size",),
    avg_response_size: ("response_size",),
    error_urls: ("url", "status", "category", "ts"),
}


def analyse(lines: DataFrame, analysis: Callable[..., DataFrame], parser: Callable[..., DataFrame], *args) -> DataFrame:
    """An analysis of raw lines by a parser of whole logs, which takes no more of a line apart than the analysis reads."""
    return analysis(parser(lines, columns=COLUMNS.get(analysis)), *args)
