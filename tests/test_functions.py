import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hitscope import functions as fn


def _map(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_request_time(spark):
    seven = datetime(2025, 2, 10, 7, 5, 13)
    cases = {
        "10/Feb/2025:07:05:13 +0000": seven,
        "10/Feb/2025:07:05:13 ": seven,
        "10/Feb/2025:07:05:13": seven,
        "10/feb/2025:07:05:13 +0000": seven,
        "10/Feb/2025:7:5:13 +0000": seven,
        "1/Feb/2025:07:05:3 +0000": datetime(2025, 2, 1, 7, 5, 3),
        "10/Feb/2025:07:05:13 Z": seven,
        "10/Feb/2025:07:05:13 +0100": seven - timedelta(hours=1),
        "10/Feb/2025:07:05:13 +01:00": seven - timedelta(hours=1),
        "10/Feb/2025:07:05:13 -0530": seven + timedelta(hours=5, minutes=30),
        "10/Feb/2025:07:05:13 +0100 +0200": None,
        "10/Feb/2025:27:05:13 +0000": None,
        "31/Feb/2025:07:05:13 +0000": None,
        "10/Feb/2025 07:05:13 +0000": None,
        "": None,
        None: None,
    }
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = _map(spark, list(cases), "STRING", lambda c: fn.utc_wall_clock(fn.request_time(c)))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == list(cases.values())


def test_request_time_as_python_reads_it(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(5000):
        moment = datetime(1990, 1, 1) + timedelta(seconds=rng.randrange(60 * 365 * 86400))
        sign, minutes = rng.choice("+-"), rng.randrange(0, 14 * 60, 15)
        text = moment.strftime("%d/%b/%Y:%H:%M:%S ") + f"{sign}{minutes // 60:02d}{minutes % 60:02d}"
        if rng.random() < 0.2:
            i = rng.randrange(len(text))
            # Blanks and shortened fields, which Python lets pass and a log never has, are left out.
            text = text[:i] + rng.choice("x99/:+") + text[i + 1:]
        texts.append(text)

    def python(text):
        try:
            moment = datetime.strptime(text, "%d/%b/%Y:%H:%M:%S %z")
        except ValueError:
            return None
        # Spark knows no offsets beyond 18 hours, nor does any place on earth.
        if abs(moment.utcoffset()) > timedelta(hours=18):
            return None
        return moment.astimezone(timezone.utc).replace(tzinfo=None)

    got = _map(spark, texts, "STRING", lambda c: fn.utc_wall_clock(fn.request_time(c)))
    wrong = [(t, g, python(t)) for t, g in zip(texts, got) if g != python(t)]
    assert not wrong, wrong


def test_utc_wall_clock_past_2038(spark):
    row = spark.sql("SELECT timestamp'2050-01-01 00:00:00.123456Z' AS t").select(fn.utc_wall_clock(F.col("t")))
    assert row.first()[0] == datetime(2050, 1, 1, 0, 0, 0, 123456)


def test_as_utc_timestamp(spark):
    moments = [
        "2024-01-01 00:00:00",
        "2024-01-01T02:00:00+02:00",
        datetime(2024, 1, 1),
        datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2))),
    ]
    row = spark.range(1).select(*[F.unix_seconds(fn.as_utc_timestamp(m)) for m in moments]).first()
    assert set(row) == {1704067200}


def test_url_functions(spark):
    urls = ["/a?id=7&id=8", "/a?uid=5", "/a?id=x", "/products/12/x", "/categories/hats/", "/categories/hats", "", None]
    assert _map(spark, urls, "STRING", fn.product_id_from_query) == ["7", "5", None, None, None, None, None, None]
    assert _map(spark, urls, "STRING", fn.product_id_from_path) == [None] * 3 + ["12"] + [None] * 4
    assert _map(spark, urls, "STRING", fn.category_from_path) == ["unknown"] * 4 + ["hats"] + ["unknown"] * 3


def test_product_category(spark):
    urls = ["/hair/shampoo/lipstick", "/skincare/cream", "/hair/conditioner?x", "/skincare", "/eyeliner", None]
    assert _map(spark, urls, "STRING", fn.product_category) == [
        "maquillage", "soins_peau", "soins_capillaires", "autre", "maquillage", "autre"]
    own = {"b": ["x", "y"], "a": ["x"], "none": []}
    assert _map(spark, ["x", "y", "z"], "STRING", lambda c: fn.product_category(c, own, "?")) == ["b", "b", "?"]
    assert _map(spark, ["x"], "STRING", lambda c: fn.product_category(c, {}, "?")) == ["?"]


def test_status_label(spark):
    assert _map(spark, [200, 301, 403, 404, 500, 418, None], "INT", fn.status_label) == [
        "Succès", "Redirection", "Accès refusé", "Non trouvé", "Erreur serveur", "Autre", "Autre"]


@pytest.mark.parametrize("number", [2.675, 0.125, 0.375, 1.005, 1234567.891, 2599.2687283119003, 0.0, 7.0, 0.005])
def test_two_decimals_as_python_prints_them(spark, number):
    assert _map(spark, [number], "DOUBLE", fn.two_decimals) == [f"{number:.2f}"]


def test_exact_mean(spark):
    def mean(values):
        df = spark.createDataFrame([(v,) for v in values], "v BIGINT").repartition(3)
        return df.agg(fn.exact_mean(F.col("v"))).first()[0]

    big = [2**53, 1, 1, 1, 1]
    assert mean(big) == sum(big) / 5
    assert mean([1, 2, None]) == 1.5
    assert mean([]) is None
    huge = [2**63 - 1] * 4 + [5, 7]
    assert mean(huge) == sum(huge) / 6
