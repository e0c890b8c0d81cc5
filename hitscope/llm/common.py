"""What the operators of this subpackage share: tables, intermediate files, batches of bytes."""

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New path that driver and executors share.

    It lies in ``spark.checkpoint.dir``; a session without that setting gets it
    in its warehouse folder, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/hitscope-llm/{purpose}-{uuid4().hex}"


def save(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns an operator reads, whatever other columns there are; a NULL text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Bits of the sieve of ``with_ids``, and of each of its pages: 8 MB in all, whatever the number of ids.
_SIEVE, _PAGE = 1 << 26, 1 << 15


def _pages(keys: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Bitmap of the hashes of *keys* (one column, distinct) in pages, and for a row with that column its page and its bit."""
    slot = F.pmod(F.xxhash64(keys.columns[0]), F.lit(_SIEVE))
    place = (slot % _PAGE).cast("int")
    pages = keys.select((slot / _PAGE).cast("int").alias("sieve_page"), place.cast("long").alias("sieve_place"))
    # Dealt by page first: a page of few bits from every task would be more than the keys.
    pages = pages.repartition("sieve_page").groupBy("sieve_page").agg(F.bitmap_construct_agg("sieve_place").alias("sieve_bits"))
    byte = F.conv(F.hex(F.substring(F.col("sieve_bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return pages, (slot / _PAGE).cast("int") == F.col("sieve_page"), F.getbit(byte, place % 8) == 1


def with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of *docs* whose ``doc_id`` is among *ids* (one column, distinct).

    A bitmap of the ids' hashes, of fixed size and so safe to broadcast, keeps other rows' texts
    out of the shuffle of the join that follows.
    """
    pages, page, bit = _pages(ids)
    sifted = docs.join(F.broadcast(pages), page).filter(bit)
    # A set number of partitions, so that texts that are few for the shuffle do not come in large ones for Python.
    sifted = sifted.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    # An inner join, as a semi join would be pushed below the one with the bitmap.
    return sifted.drop("sieve_page", "sieve_bits").join(ids, "doc_id")


def perhaps_among(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """*rows* with a boolean column *name*: true for all whose key is among *keys* (one column, distinct), and for a few others.

    The same key gets the same answer in every row. The keys' bitmap is of fixed size, so no row moves.
    """
    pages, page, bit = _pages(keys)
    return rows.join(F.broadcast(pages), page, "left").withColumn(name, F.coalesce(bit, F.lit(False))).drop("sieve_page", "sieve_bits")


def id_bucket(doc_id, parts: int):
    """crc32 of the id as text, modulo *parts*; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows of a string or binary column in one array, and the offsets of the rows in it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets * 0
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most *limit* bytes together; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def concatenated_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ..., then those of starts[1], ..."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def sliced(batches, column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most *limit* bytes of a column (a longer row stands alone)."""
    for batch in batches:
        for start, stop in row_slices(utf8(batch.column(column))[1], limit):
            yield batch.slice(start, stop - start)
