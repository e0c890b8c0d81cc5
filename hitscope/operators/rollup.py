from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hitscope.fixed_values import FIRST_ERROR_STATUS
from hitscope.functions import as_utc_timestamp, exact_mean

ROLLUP_DIMENSIONS = ("product_id", "status", "ip", "category", "method", "url")
#: Rows at the start of a log that are looked at for a limit on the time of the first failed requests.
SAMPLE_ROWS = 10_000


def traffic_rollup(
    logs: DataFrame, dimensions: Sequence[str] = ROLLUP_DIMENSIONS, more: Mapping[str, Column] | None = None
) -> DataFrame:
    """Requests and mean size per value of every dimension, from one read of the log.

    One row per (dimension, item), with the item as text, plus a ``total`` row
    whose item is NULL. Asking each analysis for itself reads and parses the log
    once per analysis; here every line is parsed once and counted once per
    dimension before anything is shuffled. A url that names no product has no
    product row. *more* are further dimensions by name, as text columns; NULL has no row.
    """
    more = more or {}
    by_item = (
        logs.select(
            "response_size",
            F.lit(None).cast("string").alias("total"),
            *[F.col(d).cast("string").alias(d) for d in dimensions],
            *[column.alias(name) for name, column in more.items()],
        )
        .unpivot("response_size", ["total", *dimensions, *more], "dimension", "item")
        .where(~F.col("dimension").isin("product_id", *more) | F.col("item").isNotNull())
    )
    return by_item.groupBy("dimension", "item").agg(
        F.count("*").alias("requests"),
        exact_mean(F.col("response_size")).alias("avg_response_size"),
    )


def product_in_range(start, end) -> Column:
    """Product of a request between two instants, both included; a dimension for ``top_products``."""
    in_range = F.col("ts").between(as_utc_timestamp(start), as_utc_timestamp(end))
    return F.when(F.col("product_id").isNotNull() & in_range, F.col("product_id"))


def _failed() -> Column:
    return F.coalesce(F.col("status") >= FIRST_ERROR_STATUS, F.lit(True))


def failed_until(logs: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS) -> int | None:
    """Time, in microseconds, by which at least *n* requests failed; None if the first rows of the log show fewer.

    Any *n* failed requests give such a time. The first rows, which come from the first
    partitions, give a low one for a log in order of time and one that a small part of the failed requests
    precede for any other. It decides how much is counted, never what the result is.
    """
    rows = logs.select(_failed().alias("failed"), F.unix_micros("ts").alias("at")).take(sample_rows)
    times = sorted(row["at"] for row in rows if row["failed"] and row["at"] is not None)
    return times[n - 1] if len(times) >= n else None


def failed_request(until: int | None) -> Column:
    """A failed request as text, one field a line, up to a time; a dimension for ``error_urls``.

    No field holds a line feed, as the parsers' patterns do not match across one.
    """
    at = F.unix_micros("ts")
    early = F.lit(True) if until is None else F.coalesce(at <= until, F.lit(False))
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (at, F.col("status"), F.col("category"), F.col("url"))]
    return F.when(_failed() & early, F.concat_ws("\n", *fields))


def first_failed(items: DataFrame, n: int) -> DataFrame:
    """``url, status, category`` of the first *n* requests of a ``failed_request`` dimension, as ``error_urls`` has them."""
    fields = F.split("item", "\n", 4)
    return (
        items.select(
            F.get(fields, F.lit(0)).try_cast("bigint").alias("at"),
            F.get(fields, F.lit(1)).try_cast("bigint").alias("status"),
            F.get(fields, F.lit(2)).alias("category"),
            F.get(fields, F.lit(3)).alias("url"),
            F.explode(F.sequence(F.lit(1), F.least(F.col("requests"), F.lit(n)).cast("int"))).alias("copy"),
        )
        .orderBy(F.asc_nulls_last("at"), "url", "status")
        .limit(n)
        .select("url", "status", "category")
    )
