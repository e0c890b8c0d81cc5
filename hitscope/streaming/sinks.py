from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hitscope.streaming.compaction import BATCH, batches_in, fold_batches, manifest
from hitscope.streaming.folders import Folder

_RUN = "_run"


def run_of(spark: SparkSession) -> str | None:
    """Id that the checkpoint of the query holds whose micro-batch this thread works on; None outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def append_batch(
    sink_format: str = "parquet",
    path: str | None = None,
    files: int | None = None,
    ledger: str | None = None,
    **options: str,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends each micro-batch to a store.

    With a ``path``, batch *n* owns the folder ``batch_id=n`` and replaces it, so
    a batch that runs again after a failure leaves no duplicates. A new checkpoint
    counts its batches from 0 again, so the folder keeps the id of the first
    checkpoint that wrote to it, and any other is refused before it writes.

    Any other format gets ``batch_id`` as a column and plain appends; there a replay may
    repeat rows, which ``latest_counts`` ignores. With a folder for a ``ledger``
    it does not: rows get ``run_id`` as well, the ledger notes each batch before
    and after it is written, a batch noted as written is passed over, and of one that was
    begun only those rows are appended that the store does not hold, read back with the
    same format and options.

    A batch comes in as many partitions as the query has state, each a file of
    its own. ``files`` gathers what has changed into fewer, by a shuffle of the
    results only, so that the state work stays as wide as it was.
    """
    if path is not None and ledger is not None:
        raise ValueError("a path needs no ledger, its batches replace themselves")

    def write(batch: DataFrame, batch_id: int) -> None:
        if files is not None:
            batch = batch.repartition(files)
        if path is not None:
            _claim(batch.sparkSession, path, batch_id)
            batch.write.format(sink_format).options(**options).mode("overwrite").save(f"{path.rstrip('/')}/{BATCH}{batch_id}")
        elif ledger is not None:
            _append_once(batch, batch_id, sink_format, ledger, options)
        else:
            numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            numbered.write.format(sink_format).options(**options).mode("append").save()

    return write


def _claim(spark: SparkSession, path: str, batch_id: int) -> None:
    """Refuse a folder that another checkpoint has written to."""
    folder, run = Folder(spark, path), run_of(spark)
    held = folder.read(_RUN)
    if held is None:
        # Batches without a run id: from before there was one, or written outside of a stream.
        others = [n for n in batches_in(folder) if run is not None or n != batch_id]
        if batch_id == 0 and others:
            raise ValueError(f"{path} holds batches of another checkpoint, such as {BATCH}{others[0]}")
        held = run if run is None else folder.write_once(_RUN, run)
    if run is not None and held != run:
        raise ValueError(f"{path} holds batches of another checkpoint, {held}; this one is {run}")


def _append_once(batch: DataFrame, batch_id: int, sink_format: str, ledger: str, options: dict[str, str]) -> None:
    spark = batch.sparkSession
    run = run_of(spark) or "none"
    folder, begun, done = Folder(spark, ledger), f"{run}/{batch_id}.begun", f"{run}/{batch_id}.done"
    if folder.read(done) is not None:
        # The rows are there, but the state behind them has yet to be committed for this batch.
        batch.write.format("noop").mode("overwrite").save()
        return
    rows = batch.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
    if folder.read(begun) is None:
        folder.write_once(begun, "")
    else:
        held = spark.read.format(sink_format).options(**options).schema(rows.schema).load()
        rows = rows.exceptAll(held.where((F.col("run_id") == run) & (F.col("batch_id") == batch_id)))
    rows.write.format(sink_format).options(**options).mode("append").save()
    folder.write_once(done, "")
    # A restart runs the last batch again at most; the ledger keeps some more of them.
    for name in folder.names(run):
        if int(name.split(".")[0]) < batch_id - 100:
            folder.remove(f"{run}/{name}")


def print_batch(batch: DataFrame, batch_id: int) -> None:
    """``foreachBatch`` function that prints all rows of a micro-batch, fetched one partition at a time."""
    print(f"batch {batch_id}", *batch.columns, sep="\t")
    for row in batch.toLocalIterator():
        print(*row, sep="\t")


def read_changelog(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sink_format: str = "parquet",
    missing_ok: bool = False,
) -> DataFrame:
    """Everything ``append_batch`` wrote to ``path``, with ``batch_id``.

    Of what ``compact_changelog`` has folded, the last row of each key. A path
    that does not exist is an error, or with *missing_ok* an empty changelog, as
    before the first batch.
    """
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    folded = manifest(Folder(spark, path))
    try:
        batches = spark.read.format(sink_format).schema(full).load(path)
    except AnalysisException as e:
        if not missing_ok or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    if folded is None:
        return batches
    base = spark.read.format(sink_format).schema(full).load(f"{path.rstrip('/')}/{folded['base']}")
    return batches.where(F.col("batch_id") > folded["up_to"]).unionByName(base)


def compact_changelog(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: StructType,
    up_to: int | None = None,
    sink_format: str = "parquet",
    **options: str,
) -> int | None:
    """Fold the batches up to *up_to* of a changelog into the last row of each key; the last batch folded.

    By default that is all but the last batch, which a restart may write again; a
    batch that is not closed is refused. The fold is written first and a manifest
    names it then, in one step that readers see or do not see, so a
    changelog folds to the same counts before, during and after, and a call that was killed can
    just be made again. Folders that this fold replaces stay until the next one, for
    readers that have begun; those replaced by the one before are removed. The stream may go on meanwhile, but one
    fold at a time.
    """
    return fold_batches(
        Folder(spark, path),
        lambda: read_changelog(spark, path, schema, sink_format),
        lambda rows, base: rows.write.format(sink_format).options(**options).save(f"{path.rstrip('/')}/{base}"),
        keys,
        up_to,
    )
