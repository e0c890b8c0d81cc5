"""The shape of the physical plans, where speed at scale is decided."""

import re

import pytest
from pyspark.sql import functions as F

from hitscope import operators as op
from hitscope.plans.registry import QUERIES
from hitscope.sources import read_log_lines

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "a.log"
    path.write_text("x\n")
    return read_log_lines(spark, str(path))


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_no_python_worker_and_no_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|Arrow|Join|Cartesian", plan), plan


@pytest.mark.parametrize("parser", [op.parse_access_log, op.parse_extended_log, op.parse_basic_log])
def test_one_regex_pass_per_line(lines, parser):
    logs = parser(lines)
    for result in (logs, op.method_distribution(logs), logs.where("status = 404").groupBy("url").count()):
        assert _plan(result).count("regexp_replace(") == 1


@pytest.mark.parametrize("alert", [op.error_spikes, op.trending_products, op.suspicious_ips])
def test_time_is_parsed_once_and_after_the_filter(lines, alert):
    plan = _plan(alert(op.parse_stream_tokens(lines)))
    assert plan.count("gettimestamp(") == 1
    assert plan.count("split(") == 1
    if alert is not op.suspicious_ips:
        # Plans print from the result down to the scan.
        assert re.search(r"gettimestamp.*Filter.*split\(", plan, re.S)


def test_a_time_range_parses_the_time_once_and_for_products_only(lines):
    plan = _plan(op.top_products(op.parse_extended_log(lines)))
    assert plan.count("gettimestamp(") == 1
    assert re.search(r"gettimestamp.*Filter.*/products/", plan, re.S)


def test_unused_columns_are_not_computed(lines):
    plan = _plan(op.status_distribution(op.parse_access_log(lines)))
    assert "gettimestamp" not in plan
    assert "Contains" not in plan


@pytest.mark.parametrize("name", ["top_ips", "most_active_ip", "top_urls", "least_urls", "top_products", "error_urls"])
def test_lists_use_a_heap(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize(
    "name", ["product_views", "top_ips", "avg_size_by_category", "suspicious_ips", "traffic_rollup", "status_counts"])
def test_one_shuffle_after_partial_aggregation(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert plan.count("Exchange") == 1
    assert re.search(r"HashAggregate.*Exchange.*HashAggregate\(.*partial_", plan, re.S)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = _plan(QUERIES["requests_by_ip"](spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "props" not in schema and not re.search(r"\bvalue:", schema)


def test_a_hot_key_shuffles_as_one_row_per_task(spark):
    lines = spark.range(0, 200_000, 1, 8).select(
        F.concat(
            F.when(F.col("id") % 3 == 0, F.lit("6.6.6.6")).otherwise(F.concat(F.lit("1.1.1."), F.col("id") % 50)),
            F.lit(' - - [10/Feb/2025:07:05:13 +0000] "GET / HTTP/1.1" 200 5'),
        ).alias("value")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = op.requests_by_ip(op.parse_access_log(lines))
        rows = {r.ip: r.requests for r in counts.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(rows.values()) == 200_000
    assert rows["6.6.6.6"] == 66_667

    def nodes(node):
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    metrics = [n.metrics() for n in nodes(counts._jdf.queryExecution().executedPlan())]
    written = [m.apply("shuffleRecordsWritten").value() for m in metrics if m.contains("shuffleRecordsWritten")]
    assert len(written) == 1 and written[0] <= 8 * 51


@pytest.mark.parametrize("parser", [op.parse_access_log, op.parse_extended_log, op.parse_basic_log])
def test_the_plan_follows_the_columns_asked_for(lines, parser):
    def plan(*columns):
        return _plan(parser(lines, columns=columns))

    none, one, two = plan(), plan("status"), plan("method", "status")
    assert "RLIKE" in none and "regexp_" not in none
    assert one.count("regexp_extract(") == 1 and "RLIKE" not in one and "regexp_replace(" not in one and "split(" not in one
    assert two.count("regexp_replace(") == 1 and "$4" not in two and "$6" not in two
    if parser is not op.parse_basic_log:
        assert plan("product_id", "url").count("regexp_extract(value") == 1  # both from the url


def test_analyses_ask_for_what_they_read(lines):
    assert "RLIKE" in _plan(op.analyse(lines, op.total_requests, op.parse_access_log))
    for analysis in (op.status_distribution, op.top_ips, op.method_distribution, op.top_urls, op.product_views, op.avg_response_size):
        plan = _plan(op.analyse(lines, analysis, op.parse_access_log))
        assert plan.count("regexp_extract(value") == 1 and "regexp_replace(" not in plan
        assert plan.count("FileScan") == 1


@pytest.mark.parametrize("watermark", [None, "10 minutes"])
def test_all_alerts_take_one_read_one_parse_and_one_aggregate(lines, watermark):
    plan = _plan(op.all_alerts(op.parse_stream_tokens(lines), watermark=watermark))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("Generate inline") <= 3
    assert plan.count("gettimestamp(") == 1
    assert re.search(r"HashAggregate.*Exchange.*HashAggregate\(.*partial_", plan, re.S)


def test_a_stream_of_all_alerts_has_one_source_and_one_state(spark, tmp_path):
    from hitscope.sources import read_log_stream
    from hitscope.streaming import append_batch, await_all, start_all_alerts, stream_session

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text('1.1.1.1 - - [10/Feb/2025:07:01:00 +0000] "GET /x HTTP/1.1" 404 5\n')
    logs = op.parse_stream_tokens(read_log_stream(stream_session(spark, 2), "text", {"path": str(tmp_path / "in")}))
    query = start_all_alerts(logs, str(tmp_path / "checkpoint"), append_batch(path=str(tmp_path / "out")), trigger={"availableNow": True})
    await_all([query])
    progress = query.recentProgress[0]
    assert len(progress.sources) == 1 and len(progress.stateOperators) == 1
    assert progress.stateOperators[0].numRowsTotal == 2  # the 404 and the address


@pytest.mark.parametrize("line_format", ["current", "extended", "basic"])
def test_reports_at_once_scan_the_log_once(spark, tmp_path, line_format, monkeypatch):
    from hitscope.plans import programs, report_at_once

    (tmp_path / "a.log").write_text("x\n")
    rollups = []
    real = programs.traffic_rollup
    monkeypatch.setattr(programs, "traffic_rollup", lambda *args: rollups.append(real(*args)) or rollups[-1])
    reports = report_at_once(read_log_lines(spark, str(tmp_path / "a.log")), line_format, str(tmp_path / "counts"))
    assert len(rollups) == 1 and _plan(rollups[0]).count("FileScan") == 1 and _plan(rollups[0]).count("Exchange") == 1
    for name, report in reports.items():
        assert ("a.log" in _plan(report)) == name.startswith("preview"), name
