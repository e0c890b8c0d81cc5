from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def decode_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payload as text: ``value`` cast to STRING, plus the columns to keep."""
    return messages.select(*keep, F.col("value").cast("string").alias("value"))


def read_log_stream(
    spark: SparkSession,
    source: str,
    options: dict[str, str],
    schema: StructType | str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Unbounded log messages, ``value STRING``.

    ``source`` is any streaming format with a ``value`` column: ``kafka``
    (``kafka.bootstrap.servers``, ``subscribe``; its package must be on the
    class path), ``text`` over a growing folder (``path``), and so on.
    """
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return decode_messages(reader.load(), keep)
