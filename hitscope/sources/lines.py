from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_log_lines(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """Raw lines, ``value STRING``, of any files, folders or globs Hadoop can open.

    Plain and bzip2 files split; a file in another compression, such as gzip, is
    one task however large it is.
    """
    return spark.read.options(**options).text(path if isinstance(path, str) else list(path))
