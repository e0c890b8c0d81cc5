from uuid import uuid4

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, purpose: str) -> str:
    """New path in a folder that every node of the cluster sees.

    That is ``spark.checkpoint.dir``, or the warehouse folder of a session
    without that setting. What is written there is the caller's to remove.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    return f"{root.rstrip('/')}/hitscope/{purpose}-{uuid4().hex}"
