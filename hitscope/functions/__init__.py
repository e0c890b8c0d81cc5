"""Column functions: each takes and returns a ``Column``, all run in the JVM."""

from hitscope.functions.aggregates import exact_mean
from hitscope.functions.labels import product_category, status_label
from hitscope.functions.text import two_decimals
from hitscope.functions.time import as_utc_timestamp, request_time, utc_wall_clock
from hitscope.functions.urls import category_from_path, product_id_from_path, product_id_from_query

__all__ = [
    "as_utc_timestamp",
    "category_from_path",
    "exact_mean",
    "product_category",
    "product_id_from_path",
    "product_id_from_query",
    "request_time",
    "status_label",
    "two_decimals",
    "utc_wall_clock",
]
