from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_counts(
    changelog: DataFrame, keys: Sequence[str], count: str = "requests", order: str = "batch_id"
) -> DataFrame:
    """Current count per key from the rows an update-mode query emitted.

    Such a query emits a key again each time its count changes; the row of the
    last batch holds the total. A batch written twice changes nothing.
    """
    return changelog.groupBy(*keys).agg(F.max_by(count, order).alias(count))
