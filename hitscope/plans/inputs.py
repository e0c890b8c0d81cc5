"""Log lines made from the ``events`` table, the input of the registered queries.

Every event becomes one line, some of them malformed, without a zone, with a
``-`` size or without the extended tail, so that all branches of the parsers
are taken. The text of the SQL is valid in Spark and in the SQL engine that
checks the results, but for the three names in braces.
"""

from pyspark.sql import DataFrame, SparkSession

_LINE_SQL = """
CASE WHEN event_id % 97 = 0 THEN 'malformed line ' || event_id ELSE
 {ip} || ' - - [' || {date} ||
 CASE WHEN event_id % 89 = 0 THEN ' ] "' ELSE ' +0000] "' END ||
 CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'GET' WHEN 'purchase' THEN 'POST'
   WHEN 'signup' THEN 'PUT' ELSE 'DELETE' END || ' ' ||
 CASE event_id % 11 WHEN 0 THEN '/lipstick?id=' || (user_id % 20) WHEN 1 THEN '/foundation'
   WHEN 2 THEN '/mascara?id=' || (user_id % 20) WHEN 3 THEN '/eyeliner'
   WHEN 4 THEN '/skincare/cream?id=' || (user_id % 7) WHEN 5 THEN '/skincare/sunscreen'
   WHEN 6 THEN '/hair/shampoo?id=' || (user_id % 5) WHEN 7 THEN '/hair/conditioner'
   WHEN 8 THEN '/products/' || (user_id % 9)
   WHEN 9 THEN '/categories/cat' || (user_id % 4) || '/list' ELSE '/home' END ||
 ' HTTP/1.1" ' ||
 CASE event_type WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN '404' WHEN 1 THEN '500' ELSE '403' END
   WHEN 'signup' THEN '301' WHEN 'purchase' THEN '201' ELSE '200' END || ' ' ||
 CASE WHEN event_id % 101 = 0 THEN '-' ELSE CAST(200 + (event_id * 37) % 4801 AS {string}) END ||
 CASE WHEN event_id % 2 = 0 THEN ' "-" "Mozilla/5.0 (X11; Linux x86_64)" ' || (event_id % 500)
   ELSE ' "Mozilla/5.0 (X11; Linux x86_64)"' END
END"""

_SPREAD_IP = "'10.0.0.' || user_id"
_BURST_IP = "'10.0.0.' || (user_id % 10)"

_SPARK_SPREAD_DATE = "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')"
_SPARK_BURST_DATE = (
    "date_format(timestampadd(SECOND, event_id * 3 div 100, timestamp_ntz'2024-01-01 00:00:00'),"
    " 'dd/MMM/yyyy:HH:mm:ss')"
)
_CHECK_SPREAD_DATE = "strftime(ts, '%d/%b/%Y:%H:%M:%S')"
_CHECK_BURST_DATE = (
    "strftime(timestamp '2024-01-01 00:00:00' + to_seconds(event_id * 3 // 100), '%d/%b/%Y:%H:%M:%S')"
)

#: The log that comes in parts of so many days, one of so many lines a part late, and how late a line may be.
PART_DAYS, LATE_EVERY, LATENESS = 10, 7, "6 hours"

# A micro-batch is what a failure repeats.
_BATCH_BYTES = 256 << 30


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def with_log_line(events: DataFrame, burst: bool = False, more: str | None = None) -> DataFrame:
    """``event_id`` and the line of each event, as ``value``, with *more*, an expression on the event.

    *burst* packs the same events into 2,000 lines a minute from ten addresses,
    the traffic that the alert limits are made for.
    """
    line = _LINE_SQL.format(
        ip=_BURST_IP if burst else _SPREAD_IP,
        date=_SPARK_BURST_DATE if burst else _SPARK_SPREAD_DATE,
        string="STRING",
    )
    return events.selectExpr("event_id", f"{line} AS value", *([more] if more else []))


def log_lines(spark: SparkSession, sf_dir: str, burst: bool = False) -> DataFrame:
    return with_log_line(spark.read.parquet(events_path(sf_dir)), burst)


def log_line_stream(spark: SparkSession, sf_dir: str, burst: bool = False) -> DataFrame:
    """The same lines as a stream of binary messages, in bounded micro-batches."""
    path = events_path(sf_dir)
    events = (
        spark.readStream.schema(spark.read.parquet(path).schema)
        .option("maxBytesPerTrigger", str(_BATCH_BYTES))
        # A bracket makes it a glob, which a stream accepts for a file and a folder alike.
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )
    return with_log_line(events, burst).selectExpr("event_id", "CAST(value AS BINARY) AS value")


def line_sql(burst: bool = False) -> str:
    """Query for the same lines, for the engine that checks the results."""
    line = _LINE_SQL.format(
        ip=_BURST_IP if burst else _SPREAD_IP,
        date=_CHECK_BURST_DATE if burst else _CHECK_SPREAD_DATE,
        string="VARCHAR",
    )
    return f"SELECT event_id, {line} AS value FROM events"
