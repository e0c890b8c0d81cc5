import random
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hitscope import operators as op
from hitscope.fixed_values import (
    BASIC_PATTERN,
    CURRENT_PATTERN,
    EXTENDED_PATTERN,
    STREAM_TIME_PATTERN,
    STREAM_URL_PATTERN,
)
from hitscope.functions import utc_wall_clock
from tests.lines import LINES

PATTERNS = {"current": CURRENT_PATTERN, "extended": EXTENDED_PATTERN, "basic": BASIC_PATTERN}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(list(LINES.items()), "name STRING, value STRING")


def _by_name(df):
    if "ts" in df.columns:
        df = df.withColumn("ts", utc_wall_clock(F.col("ts")))
    return {row.name: row.asDict() for row in df.collect()}


def test_current_format(lines):
    logs = _by_name(op.parse_access_log(lines, ["name"]))
    assert logs.keys() == {
        "plain", "no_zone", "offset", "bad_date", "path_category", "blank_in_url", "huge_numbers"}
    assert logs["plain"] == {
        "name": "plain", "ip": "192.168.1.1", "ts": datetime(2025, 2, 10, 7, 5, 13), "method": "GET",
        "url": "/products/12?id=7", "status": 404, "response_size": 512, "product_id": "7", "category": "autre"}
    assert logs["no_zone"]["ts"] == datetime(2025, 2, 10, 7, 5, 13)
    assert logs["no_zone"]["product_id"] is None
    assert logs["offset"]["ts"] == datetime(2025, 2, 10, 6, 5, 13)
    assert logs["offset"]["category"] == "soins_peau"
    assert logs["path_category"]["ts"] == datetime(2025, 2, 10, 12, 35, 13)
    assert logs["bad_date"]["ts"] is None
    assert logs["bad_date"]["product_id"] == "5"
    assert logs["bad_date"]["category"] == "maquillage"
    assert logs["blank_in_url"]["url"] == "/a b"
    assert logs["huge_numbers"]["status"] == 99999999999
    assert logs["huge_numbers"]["response_size"] is None


def test_extended_format(lines):
    logs = _by_name(op.parse_extended_log(lines, ["name"]))
    assert logs.keys() == {"plain", "path_category"}
    assert (logs["plain"]["product_id"], logs["plain"]["category"]) == ("12", "unknown")
    assert (logs["path_category"]["product_id"], logs["path_category"]["category"]) == ("3", "hats")


def test_basic_format(lines):
    logs = _by_name(op.parse_basic_log(lines, ["name"]))
    assert logs["offset"]["timestamp_text"] == "10/Feb/2025:07:05:13 +0100"
    assert set(LINES) - logs.keys() == {"no_size", "short", "not_at_start", "empty", "null"}


@pytest.mark.parametrize("line_format", PATTERNS)
def test_every_line_is_parsed_or_malformed(lines, line_format):
    parser = {"current": op.parse_access_log, "extended": op.parse_extended_log, "basic": op.parse_basic_log}
    parsed = [r.name for r in parser[line_format](lines, ["name"]).collect()]
    dropped = [r.name for r in op.malformed_lines(lines, line_format).collect()]
    assert sorted(parsed + dropped) == sorted(LINES)


def test_schemas(lines):
    plain = lambda schema: [(f.name, f.dataType) for f in schema]
    assert plain(op.parse_stream_tokens(lines).schema) == plain(op.LOG_SCHEMA)
    assert plain(op.parse_access_log(lines).schema) == plain(op.PARSED_SCHEMA)
    assert plain(op.parse_extended_log(lines).schema) == plain(op.PARSED_SCHEMA)


def test_stream_tokens(lines):
    logs = _by_name(op.parse_stream_tokens(lines, ["name"]))
    assert logs.keys() == LINES.keys()
    assert logs["offset"] == {
        "name": "offset", "ip": "192.168.1.1", "ts": datetime(2025, 2, 10, 6, 5, 13), "method": "POST",
        "url": "/skincare/cream?id=7", "status": 200}
    assert logs["no_zone"]["ts"] == datetime(2025, 2, 10, 7, 5, 13)
    assert logs["no_size"]["status"] == 304
    assert logs["short"] == {
        "name": "short", "ip": "x", "ts": None, "method": None, "url": None, "status": None}
    assert logs["blank_in_url"]["status"] is None
    assert logs["null"]["ip"] is None


def test_stream_regex(lines):
    logs = _by_name(op.parse_stream_regex(lines, ["name"]))
    assert logs.keys() == LINES.keys()
    assert logs["plain"] == {
        "name": "plain", "ip": "192.168.1.1", "timestamp_text": "10/Feb/2025:07:05:13 +0000", "method": "GET",
        "url": "/products/12?id=7", "protocol": 'HTTP/1.1"', "status": 404, "size": 512}
    assert (logs["no_size"]["status"], logs["no_size"]["size"]) == (304, None)
    assert logs["short"]["method"] == ""
    assert logs["blank_in_url"]["url"] == "/a b"
    assert (logs["blank_in_url"]["status"], logs["blank_in_url"]["size"]) == (None, 200)


# Pieces that make the delimiters of a log line turn up in the wrong places.
_PREFIXES = [
    "", "1.2.3.4 - - [", '1.2.3.4 - - [t] "', '1.2.3.4 - - [t] "GET /u HTTP/1.1" 200 5',
    '1.2.3.4 - - [t] "GET /u HTTP/1.1" 200 5 "r',
]
_PIECES = [
    '] "', "]", '"', " ", "[", "GET", "/u", " HTTP/1.1", " HTTP", " HTTP/", '" 200 5', '" 404 17 "', '" "', '" 7',
    "7", "\n", "\r", "\u2028", "\u0085", "\x01", "é", "-", "1.2.3.4 - - [",
]


@pytest.mark.parametrize("line_format", PATTERNS)
def test_same_as_the_plain_pattern(spark, line_format):
    rng = random.Random(line_format)
    texts = [
        rng.choice(_PREFIXES) + "".join(rng.choices(_PIECES, k=rng.randint(1, 16))) for _ in range(60_000)
    ]
    assert _assert_same_as_plain(spark, line_format, texts) > 1000


def _assert_same_as_plain(spark, line_format, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, value STRING")
    got = {
        row[0]: tuple(row)[1:] for row in op.parsing._matched_fields(df, line_format, ["id"]).collect()
    }
    expected = {}
    for i, text in enumerate(texts):
        match = re.match(PATTERNS[line_format], text, re.ASCII)
        if match:
            expected[i] = match.groups()[:6]
    assert got == expected
    return len(expected)


def test_stream_fields_same_as_the_plain_patterns(spark):
    rng = random.Random(11)
    pieces = [*_PIECES, '"GET ', '"GET /u HTTP', "\r\n", "[t]", "\n["]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(60_000)]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    fields = op.parse_stream_regex(df, ["value"]).select(
        "timestamp_text",
        "url",
        F.regexp_extract("value", STREAM_TIME_PATTERN, 1).alias("plain_time"),
        F.regexp_extract("value", STREAM_URL_PATTERN, 1).alias("plain_url"),
    )
    assert fields.where("timestamp_text <> plain_time OR url <> plain_url").collect() == []
    assert fields.where("url <> ''").count() > 1000
    assert fields.where("timestamp_text <> ''").count() > 1000


def test_a_hostile_message_takes_one_read(spark):
    df = spark.createDataFrame([("[" * 500_000,), ('"a ' * 200_000,)], "value STRING")
    start = time.perf_counter()
    assert [(r.timestamp_text, r.url) for r in op.parse_stream_regex(df).collect()] == [("", "")] * 2
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("line_format", PATTERNS)
def test_a_hostile_line_takes_one_read(spark, line_format):
    unit = '] "a b HTTP/1 HTTP/'
    df = spark.createDataFrame([("1.2.3.4 - - [" + unit * 50_000,)], "value STRING")
    start = time.perf_counter()
    assert op.malformed_lines(df, line_format).count() == 1
    assert op.parsing._matched_fields(df, line_format, []).count() == 0
    assert time.perf_counter() - start < 20


_PARSERS = [op.parse_access_log, op.parse_extended_log, op.parse_basic_log]


@pytest.mark.parametrize("parser", _PARSERS)
def test_columns_asked_for_equal_those_of_the_whole_parse(spark, parser):
    """None, each alone and each two, on lines with empty fields, broken ends and line breaks as well."""
    awkward = [
        '1.1.1.1 - - [] "GET /a HTTP/1.1" 200 5 "r" "a" 1', '1.1.1.1 - - [t] " /a HTTP/1.1" 200 5 "" "" 1',
        '1.1.1.1 - - [t] "GET  HTTP/1.1" 200 5 "r" "a" 1', '1.1.1.1 - - [] "  HTTP/" 200 5 "r" "" 1', '1.1.1.1 - - [t] "GET /a HTTP/1.1" 200',
        '1.1.1.1 - - [a] "b] "GET /x] " HTTP/1 HTTP/1.1" 404 7 "r" "a" 1', '1.1.1.1 - - [t] "GET /é\u2028 HTTP/1.1" 500 9 "r" "a" 1',
        'x 1.1.1.1 - - [t] "GET /a HTTP/1.1" 200 5 "r" "a" 1', '1.1.1.1 - - [t] "GET /a\n HTTP/1.1" 200 5 "r" "a" 1',
        '1.1.1.1 - - [t] "GET /a\r HTTP/1.1" 200 5 "r" "a" 1\nmore',
    ]
    values = [*LINES.values(), *awkward]
    lines = spark.createDataFrame(list(enumerate(values)), "n INT, value STRING").coalesce(1)
    whole = {r.n: r.asDict() for r in parser(lines, ["n"]).collect()}
    assert len(whole) >= 8 - 3 * (parser is op.parse_extended_log)
    names = [c for c in parser(lines).columns]
    subsets = [[], *[[a] for a in names], *[[a, b] for i, a in enumerate(names) for b in names[:i]]]
    for asked in subsets:
        result = parser(lines, ["n"], columns=asked)
        assert result.columns == ["n", *(c for c in names if c in asked)]
        assert {r.n: r.asDict() for r in result.collect()} == {n: {c: row[c] for c in result.columns} for n, row in whole.items()}, asked
    with pytest.raises(ValueError, match="no such columns"):
        parser(lines, columns=["agent"])
