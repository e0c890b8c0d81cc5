from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hitscope import operators as op
from hitscope.plans import (
    basic_program,
    current_program,
    extended_program,
    one_read_program,
    shared_path,
)
from hitscope.plans.inputs import log_lines
from tests.lines import LINES

SF_DIR = "/root/testdata/sf0.001"


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _line(ip="1.1.1.1", minute=0, url="/", status=200, size=10):
    return f'{ip} - - [10/Feb/2025:07:{minute:02d}:00 +0000] "GET {url} HTTP/1.1" {status} {size} "r" "a" 1'


@pytest.fixture(scope="module")
def logs(spark):
    lines = (
        [_line("9.9.9.9", 1, "/a?id=1", 404)] * 3
        + [_line("2.2.2.2", 2, "/b?id=2", 500)] * 2
        + [_line("1.1.1.1", 3, "/lipstick?id=2", 200, 31)] * 2
        + [_line("3.3.3.3", 0, "/z", 400)]
    )
    return op.parse_access_log(spark.createDataFrame([(v,) for v in lines], "value STRING"))


def test_lists_break_ties_by_key(logs):
    assert _rows(op.top_ips(logs)) == [("9.9.9.9", 3), ("1.1.1.1", 2), ("2.2.2.2", 2), ("3.3.3.3", 1)]
    assert _rows(op.top_ips(logs, 2)) == [("9.9.9.9", 3), ("1.1.1.1", 2)]
    assert _rows(op.most_active_ip(logs)) == [("9.9.9.9", 3)]
    assert _rows(op.least_urls(logs)) == [("/z", 1), ("/b?id=2", 2), ("/lipstick?id=2", 2)]
    assert _rows(op.top_urls(logs, 1)) == [("/a?id=1", 3)]


def test_error_urls_in_order_of_time(logs):
    assert _rows(op.error_urls(logs, 2)) == [("/z", 400, "autre"), ("/a?id=1", 404, "autre")]


def test_product_range_includes_both_ends(logs):
    at = lambda minute: datetime(2025, 2, 10, 7, minute)
    assert _rows(op.top_products(logs, at(1), at(2))) == [("1", 3), ("2", 2)]
    assert _rows(op.top_products(logs, at(2), at(3))) == [("2", 4)]
    assert _rows(op.top_products(logs, "2025-02-10T08:03:00+01:00", "2025-02-10 07:03:00")) == [("2", 2)]
    assert _rows(op.top_products(logs, at(4), at(5))) == []


def test_no_requests(logs):
    none = logs.where("false")
    assert _rows(op.total_requests(none)) == [(0,)]
    assert _rows(op.avg_response_size(none)) == [(None,)]
    assert _rows(op.top_ips(none)) == []


def test_preview(spark):
    lines = spark.createDataFrame([(f"{i:03d}",) for i in range(50)], "value STRING")
    assert op.preview(lines).count() == 10
    assert _rows(op.preview(lines, 2, ["value"])) == [("000",), ("001",)]


def test_programs(spark):
    lines = spark.createDataFrame([(v,) for v in LINES.values()], "value STRING")
    assert _rows(current_program(lines)["total_requests"]) == [(7,)]
    assert _rows(extended_program(lines)["total_requests"]) == [(2,)]
    assert _rows(basic_program(lines)["total_requests"]) == [(7,)]
    for program in (current_program, extended_program, basic_program):
        for report in program(lines).values():
            report.collect()


@pytest.mark.parametrize("empty", [False, True])
def test_one_read_gives_the_same_reports(spark, empty):
    lines = log_lines(spark, SF_DIR)
    if empty:
        lines = lines.where("false")
    logs = op.parse_access_log(lines)
    at_once = one_read_program(logs, shared_path(spark, "rollup"))
    singly = {
        "product_views": op.product_views(logs),
        "status_distribution": op.status_distribution(logs),
        "top_ips": op.top_ips(logs),
        "avg_size_by_category": op.avg_size_by_category(logs),
        "total_requests": op.total_requests(logs),
        "method_distribution": op.method_distribution(logs),
        "top_urls": op.top_urls(logs),
        "least_urls": op.least_urls(logs),
        "avg_response_size": op.avg_response_size(logs),
    }
    assert at_once.keys() == singly.keys()
    for name, report in singly.items():
        assert at_once[name].columns == report.columns
        assert sorted(_rows(at_once[name]), key=str) == sorted(_rows(report), key=str), name


def test_alert_limits_and_windows(spark):
    lines = [_line("1.1.1.1", 3, "/products/1")] * 21 + [_line("1.1.1.1", 4, "/products/1")] * 20
    lines += [_line("2.2.2.2", 4, "/x")] * 101 + [_line("3.3.3.3", 4, "/x", 404)] * 100
    lines += [_line("4.4.4.4", 5, "/x", 500), "x", None]
    logs = op.parse_stream_tokens(spark.createDataFrame([(v,) for v in lines], "value STRING"))
    minute = lambda column: F.date_format(column, "HH:mm")

    def alert(df):
        return sorted(_rows(df.withColumns({c: minute(F.col(c)) for c in ("window_start", "window_end")})))

    assert alert(op.trending_products(logs)) == [("07:03", "07:04", "/products/1", 21)]
    assert alert(op.suspicious_ips(logs)) == [("07:04", "07:05", "2.2.2.2", 101)]
    assert alert(op.suspicious_ips(logs, more_than=99, width="5 minutes")) == [
        ("07:00", "07:05", "2.2.2.2", 101), ("07:00", "07:05", "3.3.3.3", 100)]
    assert alert(op.error_spikes(logs)) == [("07:00", "07:05", 404, 100), ("07:05", "07:10", 500, 1)]
    assert alert(op.error_spikes(logs, [200], "1 hour")) == [("07:00", "08:00", 200, 142)]
    assert sorted(_rows(op.status_counts(logs)), key=str) == [(200, 142), (404, 100), (500, 1), (None, 2)]


@pytest.mark.parametrize("sample_rows", [10_000, 30, 1])
@pytest.mark.parametrize("line_format", ["current", "extended", "basic"])
def test_reports_at_once_equal_the_programs(spark, monkeypatch, line_format, sample_rows):
    """On a log in no order, with repeated failed requests and some without a time, whatever the sample shows."""
    from hitscope.operators import rollup
    from hitscope.plans import report_at_once

    made = log_lines(spark, SF_DIR).orderBy(F.xxhash64("event_id")).select("value")
    own = [v for v in LINES.values()] * 3 + [_line("1.1.1.1", 3, "/same", 500)] * 4
    lines = made.union(spark.createDataFrame([(v,) for v in own], "value STRING"))
    monkeypatch.setattr(rollup.failed_until, "__defaults__", (sample_rows,))
    program = {"current": current_program, "extended": extended_program, "basic": basic_program}[line_format](lines)
    at_once = report_at_once(lines, line_format, shared_path(spark, "rollup"))
    assert list(at_once) == list(program)
    for name, report in program.items():
        assert at_once[name].columns == report.columns
        if not name.startswith("preview"):
            ordered = name in ("error_urls", "top_ips", "top_products", "top_urls", "least_urls")
            order = list if ordered else (lambda rows: sorted(rows, key=str))
            assert order(_rows(at_once[name])) == order(_rows(report)), name


@pytest.mark.parametrize("statuses", [[], [500], [500] * 9, [500] * 30])
def test_failed_requests_at_once_when_there_are_few(spark, statuses):
    from hitscope.plans import report_at_once

    lines = [_line("1.1.1.1", 50 - i, f"/u{i % 4}", status) for i, status in enumerate([200] * 20 + statuses)]
    lines += [LINES["bad_date"].replace(" 200 ", " 404 "), LINES["huge_numbers"].replace("99999999999 ", "9" * 30 + " ")]
    table = spark.createDataFrame([(v,) for v in lines], "value STRING")
    at_once = report_at_once(table, "current", shared_path(spark, "rollup"))["error_urls"]
    assert _rows(at_once) == _rows(current_program(table)["error_urls"])
    assert len(_rows(at_once)) == min(10, len(statuses) + 2)


@pytest.mark.parametrize("sf_dir", [SF_DIR])
def test_all_alerts_equal_the_three(spark, sf_dir):
    logs = op.parse_stream_tokens(log_lines(spark, sf_dir, burst=True))
    at_once = sorted(_rows(op.all_alerts(logs, op.alert_rules(suspicious_more_than=90, spike_width="7 minutes"))))
    singly = []
    for name, alert in [
        ("error_spikes", op.error_spikes(logs, width="7 minutes")), ("trending_products", op.trending_products(logs)),
        ("suspicious_ips", op.suspicious_ips(logs, 90)),
    ]:
        singly += [(name, start, end, str(item), n) for start, end, item, n in _rows(alert)]
    assert at_once == sorted(singly) and {row[0] for row in at_once} >= {"suspicious_ips"}
