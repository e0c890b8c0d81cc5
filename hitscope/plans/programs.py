"""The report programs: every analysis of a log format, by name.

Each entry is a lazy DataFrame that runs when the caller shows, writes or
collects it. Only ``one_read_program`` and ``report_at_once`` start with a job, to save their counts.
"""

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hitscope.fixed_values import (
    ERROR_URLS,
    LEAST_URLS,
    PRODUCT_RANGE_END,
    PRODUCT_RANGE_START,
    TOP_IPS,
    TOP_PRODUCTS,
    TOP_URLS,
)
from hitscope.functions import status_label
from hitscope.operators import (
    analyse,
    avg_response_size,
    avg_size_by_category,
    error_urls,
    least_urls,
    method_distribution,
    most_active_ip,
    parse_access_log,
    parse_basic_log,
    parse_extended_log,
    preview,
    product_views,
    status_distribution,
    top_ips,
    top_products,
    top_urls,
    total_requests,
    traffic_rollup,
)
from hitscope.operators.rollup import ROLLUP_DIMENSIONS, failed_request, failed_until, first_failed, product_in_range


def current_program(lines: DataFrame) -> dict[str, DataFrame]:
    """Report on a log in the current format."""
    of = lambda analysis: analyse(lines, analysis, parse_access_log)
    return {
        "product_views": of(product_views),
        "status_distribution": of(status_distribution),
        "top_ips": of(top_ips),
        "avg_size_by_category": of(avg_size_by_category),
        "total_requests": of(total_requests),
        "method_distribution": of(method_distribution),
        "error_urls": of(error_urls),
    }


def extended_program(
    lines: DataFrame,
    start: datetime | str = PRODUCT_RANGE_START,
    end: datetime | str = PRODUCT_RANGE_END,
) -> dict[str, DataFrame]:
    """Report on a log in the extended format."""
    of = lambda analysis, *args: analyse(lines, analysis, parse_extended_log, *args)
    return {
        "top_products": of(top_products, start, end),
        "status_distribution": of(status_distribution).drop("label"),
        "top_ips": of(top_ips),
        "avg_size_by_category": of(avg_size_by_category),
        "total_requests": of(total_requests),
        "top_urls": of(top_urls),
        "method_distribution": of(method_distribution),
    }


def basic_program(lines: DataFrame) -> dict[str, DataFrame]:
    """Report on a log in the basic format, with previews of the input."""
    of = lambda analysis: analyse(lines, analysis, parse_basic_log)
    return {
        "preview_lines": preview(lines),
        "preview_parsed": preview(parse_basic_log(lines)),
        "total_requests": of(total_requests),
        "top_urls": of(top_urls),
        "least_urls": of(least_urls),
        "method_distribution": of(method_distribution),
        "avg_response_size": of(avg_response_size),
        "most_active_ip": of(most_active_ip),
    }


def one_read_program(
    logs: DataFrame, path: str, mode: str = "errorifexists", more: Mapping[str, Column] | None = None
) -> dict[str, DataFrame]:
    """The counting reports from a single read of a parsed log, of any format.

    Writes ``traffic_rollup`` to ``path``, one folder per dimension, and answers
    each report from its folder. Against one job per report this reads and
    parses the log once instead of once for each. Reports on columns that the
    format lacks are left out. *more* are further dimensions of the rollup: ``top_products`` and
    ``error_urls`` are reports if it has a dimension of that name.
    """
    dimensions = [d for d in ROLLUP_DIMENSIONS if d in logs.columns]
    rollup = traffic_rollup(logs, dimensions, more)
    rollup.write.partitionBy("dimension").mode(mode).parquet(path)
    saved = logs.sparkSession.read.schema(rollup.schema).parquet(path)

    def items(dimension: str) -> DataFrame:
        return saved.where(F.col("dimension") == dimension)

    def of(dimension: str, *measures: Column | str, column: str | None = None) -> DataFrame:
        column = column or dimension
        return items(dimension).select(F.col("item").cast(logs.schema[column].dataType).alias(column), *measures)

    def by_count(dimension: str) -> DataFrame:
        return of(dimension, "requests")

    # The total is one row, or none for an empty log; aggregating gives one in either case.
    total = items("total").agg(
        F.coalesce(F.sum("requests"), F.lit(0)).alias("requests"),
        F.max("avg_response_size").alias("avg_response_size"),
    )
    reports = {
        "product_views": ("product_id", lambda d: of(d, F.col("requests").alias("views"))),
        "status_distribution": (
            "status",
            lambda d: of(d, status_label(F.col("item").cast("bigint")).alias("label"), "requests"),
        ),
        "top_ips": ("ip", lambda d: by_count(d).orderBy(F.desc("requests"), d).limit(TOP_IPS)),
        "avg_size_by_category": ("category", lambda d: of(d, "avg_response_size")),
        "method_distribution": ("method", by_count),
        "top_urls": ("url", lambda d: by_count(d).orderBy(F.desc("requests"), d).limit(TOP_URLS)),
        "least_urls": ("url", lambda d: by_count(d).orderBy("requests", d).limit(LEAST_URLS)),
    }
    extra = {
        "top_products": lambda d: of(d, F.col("requests").alias("views"), column="product_id")
        .orderBy(F.desc("views"), "product_id")
        .limit(TOP_PRODUCTS),
        "error_urls": lambda d: first_failed(items(d), ERROR_URLS),
    }
    return {
        "total_requests": total.select("requests"),
        "avg_response_size": total.select("avg_response_size"),
        **{name: report(d) for name, (d, report) in reports.items() if d in dimensions},
        **{name: extra[name](name) for name in more or {}},
    }


def report_at_once(
    lines: DataFrame,
    line_format: str,
    path: str,
    mode: str = "errorifexists",
    start: datetime | str = PRODUCT_RANGE_START,
    end: datetime | str = PRODUCT_RANGE_END,
) -> dict[str, DataFrame]:
    """The same reports as the program of a format ("current", "extended", "basic"), from one read of the log.

    The first failed requests take a look at the first rows of the log beforehand, and previews
    read as much as they show. ``path`` keeps the counts.
    """
    if line_format == "current":
        logs = parse_access_log(lines)
        reports = one_read_program(logs, path, mode, {"error_urls": failed_request(failed_until(logs, ERROR_URLS))})
        names = current_program(lines)
    elif line_format == "extended":
        reports = one_read_program(parse_extended_log(lines), path, mode, {"top_products": product_in_range(start, end)})
        reports["status_distribution"] = reports["status_distribution"].drop("label")
        names = extended_program(lines)
    else:
        logs = parse_basic_log(lines)
        reports = one_read_program(logs, path, mode)
        reports |= {"preview_lines": preview(lines), "preview_parsed": preview(logs)}
        reports["most_active_ip"] = reports["top_ips"].orderBy(F.desc("requests"), "ip").limit(1)
        names = basic_program(lines)
    return {name: reports[name] for name in names}
