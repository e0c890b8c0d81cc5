"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from hitscope.plans.checks import ORACLE_SQL
from hitscope.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def check():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    yield con
    con.close()


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is not None, str(type(v)), v if v is not None else 0) for v in row])


def test_every_query_has_a_check():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, check, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = check.sql(ORACLE_SQL[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = _rows([tuple(r) for r in result.collect()], result.columns)
    assert got == _rows(expected.fetchall(), expected.columns)
    assert got


def test_results_do_not_depend_on_the_session_time_zone(spark):
    names = ["parse_access_log", "error_spikes"]
    def run():
        return [_rows([tuple(r) for r in QUERIES[n](spark, SF_DIR).collect()], QUERIES[n](spark, SF_DIR).columns)
                for n in names]
    in_utc = run()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert run() == in_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_known_counts_of_the_derived_log(spark):
    """Row counts worked out once from the sf0.01 events, by hand-written SQL elsewhere."""
    from hitscope import operators as op
    from hitscope.plans.inputs import log_lines

    sf_dir = "/root/testdata/sf0.01"
    spread = op.parse_access_log(log_lines(spark, sf_dir))
    burst = op.parse_access_log(log_lines(spark, sf_dir, burst=True))
    assert op.total_requests(spread).first()[0] == 9798
    assert op.error_spikes(spread).count() == 1301
    assert sorted((r.status, r.requests) for r in op.error_spikes(burst).collect()) == [(404, 676), (500, 638)]
    assert op.trending_products(burst).count() == 18
    assert op.suspicious_ips(burst).count() == 50
    assert spread.where("status >= 400").count() == 1968
