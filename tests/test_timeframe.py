from datetime import datetime

import pytest

from wickwork.functions import timeframe as T

D = datetime


@pytest.mark.parametrize(("tf", "base", "w"), [("15m", "5m", 3), ("1h", "5m", 12), ("30m", "1m", 30), ("1d", "1h", 24)])
def test_ratio(tf, base, w):
    assert T.ratio(tf, base) == w


@pytest.mark.parametrize(("tf", "base"), [("1h", "15x"), ("30m", "1h"), ("7m", "1m")])
def test_ratio_errors(tf, base):
    with pytest.raises(ValueError):
        T.ratio(tf, base)


def test_is_base_never_raises():
    assert T.is_base("5m", "5m") and not T.is_base("nope", "5m")


@pytest.mark.parametrize(("tf", "base", "want"), [("15m", "5m", True), ("1h", "5m", True), ("5m", "15m", False), ("1h", "7m", False), ("1d", "6h", True)])
def test_is_base_of_multiples(tf, base, want):
    assert T.is_base(tf, base) is want


def test_micros_know_no_zone(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-03-10 02:30:00.123456'), (timestamp_ntz'1969-12-31 23:59:59.5'), (timestamp_ntz'2024-11-03 01:30:00'), (null) t(x)")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select("x", T.micros(df["x"]).alias("us"), T.at_micros(T.micros(df["x"])).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["us"] for r in got] == [1710037800123456, -500000, 1730597400000000, None] and all(r["x"] == r["back"] for r in got)


@pytest.mark.parametrize(("a", "b", "tf", "n"), [(D(2025, 1, 1), D(2025, 1, 1, 1), "1m", 1), (D(2025, 1, 1), D(2025, 1, 2), "5m", 1), (D(2025, 1, 1), D(2026, 1, 1), "1d", 2), (D(2025, 1, 1), D(2025, 1, 1, 0, 1), "1d", 1)])
def test_pages(a, b, tf, n):
    assert T.expected_pages(a, b, tf) == n


def test_candles():
    assert T.expected_candles(D(2025, 1, 1), D(2025, 1, 2), "1h") == 24


def test_midnight_end_is_end_of_day():
    assert T.bounds(None, "2024-02-01T00:00:00", "1h")[1] == D(2024, 2, 1, 23)
    assert T.bounds("2024-02-01 01:30", "2024-02-01T05:59:59Z", "1h") == (D(2024, 2, 1, 1, 30), D(2024, 2, 1, 5))


@pytest.mark.parametrize("args", [("2024/01/01", None, "1h"), (None, None, "7m"), ("2024-01-01T01:30:00", "2024-01-01T01:10:00", "1h")])
def test_bounds_errors(args):
    with pytest.raises(ValueError):
        T.bounds(*args)


def test_offsets_become_utc():
    assert T.naive_utc("2024-01-01T02:00:00+02:00") == D(2024, 1, 1)
