"""Pairs as ``key<TAB>value`` text, the layout of Hadoop's text output format."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

_SEPARATOR = "\t"
# Hadoop ends records at \n only when told to; a \r inside a value must survive.
_LINE_END = "\n"


def key_value_rows(spark: SparkSession, rows: Iterable[tuple], key_type: str = "INT") -> DataFrame:
    """A few pairs held by the driver."""
    return spark.createDataFrame(list(rows), f"k {key_type}, v STRING")


def write_kv_text(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write columns ``k`` and ``v``.

    As in Hadoop, a NULL value leaves the key alone, a NULL key the value alone,
    and a pair of NULLs nothing. A key or value with a line feed, which could not
    be read back, fails the write.
    """
    line = F.concat_ws(_SEPARATOR, F.col("k").cast("string"), "v")
    broken = F.raise_error(F.lit("a key or value holds a line feed, which ends a record of this format"))
    (
        pairs.where(F.col("k").isNotNull() | F.col("v").isNotNull())
        .select(F.when(line.contains(_LINE_END), broken).otherwise(line).alias("value"))
        .write.mode(mode)
        .option("lineSep", _LINE_END)
        .text(path)
    )


def read_kv_text(spark: SparkSession, path: str, key_type: str = "INT") -> DataFrame:
    """Read pairs back, splitting each line at its first tab; '' stays ''.

    A key that is not of ``key_type`` reads as NULL.
    """
    pair = F.split("value", _SEPARATOR, 2)
    return spark.read.option("lineSep", _LINE_END).text(path).select(
        F.get(pair, F.lit(0)).try_cast(key_type.lower()).alias("k"),
        F.get(pair, F.lit(1)).alias("v"),
    )


def sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs in order of key, then value.

    The row number spreads equal pairs over ranges, so that a pair which makes
    up much of the data is not one task's work.
    """
    return (
        pairs.withColumn("row_number", F.monotonically_increasing_id())
        .orderBy("k", "v", "row_number")
        .select("k", "v")
    )
