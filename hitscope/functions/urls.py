from pyspark.sql import Column, functions as F

from hitscope.fixed_values import (
    CATEGORY_PATH_PATTERN,
    PRODUCT_PATH_PATTERN,
    PRODUCT_QUERY_PATTERN,
    UNKNOWN_PATH_CATEGORY,
)


def _first_group(text: Column, pattern: str) -> Column:
    # regexp_extract gives '' for no match; no pattern here can capture ''.
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def product_id_from_query(url: Column) -> Column:
    """Digits after the first ``id=<digits>``, NULL if there are none.

    The name is not anchored: ``uid=5`` counts as product 5.
    """
    return _first_group(url, PRODUCT_QUERY_PATTERN)


def product_id_from_path(url: Column) -> Column:
    """Digits in the first ``/products/<digits>``, NULL if there are none."""
    return _first_group(url, PRODUCT_PATH_PATTERN)


def category_from_path(url: Column) -> Column:
    """Word in ``/categories/<word>/``, ``unknown`` if there is none."""
    return F.coalesce(_first_group(url, CATEGORY_PATH_PATTERN), F.lit(UNKNOWN_PATH_CATEGORY))
