from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Session of the same application, set up for stateful queries.

    State lives in RocksDB, on disk, as windows per url or address can exceed
    executor memory, and a commit uploads changes only. The number of state
    partitions is fixed by a query's first start and cannot follow the data
    later, so it is chosen here; unless given it is
    ``spark.sql.shuffle.partitions``. The caller's settings carry over, and its
    own session stays as it is.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    if state_partitions is None:
        state_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session
