from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from hitscope.fixed_values import OTHER_CATEGORY, OTHER_STATUS, PRODUCT_CATEGORIES, STATUS_LABELS


def _first_of(branches: list[tuple[Column, str]], other: str) -> Column:
    """Text of the first branch that holds, ``other`` if none does."""
    return F.coalesce(*[F.when(holds, F.lit(text)) for holds, text in branches], F.lit(other))


def status_label(
    status: Column,
    labels: Mapping[int, str] = STATUS_LABELS,
    other: str = OTHER_STATUS,
) -> Column:
    """Readable label of an HTTP status."""
    return _first_of([(status == code, text) for code, text in labels.items()], other)


def product_category(
    url: Column,
    rules: Mapping[str, Sequence[str]] = PRODUCT_CATEGORIES,
    other: str = OTHER_CATEGORY,
) -> Column:
    """First category, in the order of ``rules``, one of whose words occurs in the url."""
    branches = [(reduce(or_, [url.contains(w) for w in words]), name) for name, words in rules.items() if words]
    return _first_of(branches, other)
