"""How the reports grow with the log: lines per second at several sizes.

Writes a log of N copies of the events to the shared folder as text and times
reports on it, one at a time and all from one read. Prints one JSON line per
size. BENCH_SF_DIR, BENCH_CPUS as in bench.py; BENCH_COPIES (default 1,10,60).
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hitscope import operators as op  # noqa: E402
from hitscope.plans import one_read_program, shared_path  # noqa: E402
from hitscope.plans.inputs import events_path, with_log_line  # noqa: E402
from hitscope.sources import read_log_lines  # noqa: E402


def _seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 2)


def _consume(result) -> None:
    result.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sizes = [int(n) for n in os.environ.get("BENCH_COPIES", "1,10,60").split(",")]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hitscope-scale-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hitscope-"))  # one machine: a folder of it is shared
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(events_path(sf_dir))

    for copies in sizes:
        path = shared_path(spark, f"log-{copies}")
        repeated = events.repartition(int(cpus)).selectExpr("*", f"explode(sequence(1, {copies})) AS copy")
        with_log_line(repeated).select("value").write.text(path)
        lines = read_log_lines(spark, path)
        logs, messages = op.parse_access_log(lines), op.parse_stream_tokens(lines)
        counting = {
            "product_views": op.product_views,
            "status_distribution": op.status_distribution,
            "top_ips": op.top_ips,
            "avg_size_by_category": op.avg_size_by_category,
            "total_requests": op.total_requests,
            "method_distribution": op.method_distribution,
            "top_urls": op.top_urls,
            "least_urls": op.least_urls,
            "avg_response_size": op.avg_response_size,
        }
        _consume(op.status_distribution(logs))
        times = {name: _seconds(lambda: _consume(report(logs))) for name, report in counting.items()}
        times["all_in_one_read"] = _seconds(
            lambda: [_consume(r) for r in one_read_program(logs, shared_path(spark, "rollup")).values()]
        )
        times["parse_all_columns"] = _seconds(lambda: _consume(logs))
        times["error_spikes"] = _seconds(lambda: _consume(op.error_spikes(messages)))
        times["suspicious_ips"] = _seconds(lambda: _consume(op.suspicious_ips(messages)))
        count = lines.count()
        print(json.dumps({
            "lines": count,
            "seconds": times,
            "nine_reports_one_by_one": round(sum(times[name] for name in counting), 2),
            "lines_per_second": {name: round(count / t) for name, t in times.items()},
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
