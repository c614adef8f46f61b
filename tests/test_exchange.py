import os
import time

import fake_exchange as fake
import pytest

from wickwork.sources import exchange as X
from wickwork.sources import store


@pytest.fixture(autouse=True)
def _path(spark):
    here = os.path.dirname(__file__)
    spark.sparkContext.addPyFile(os.path.join(here, "fake_exchange.py"))


BOUNDS = {"start": "2024-01-01T00:00:00Z", "end": "2024-01-01T12:00:00Z"}


def test_windows():
    assert X.window_starts(0, 43_200_000, "1m") == [0, 18_000_000, 36_000_000]


def test_paging_ends():
    rows = list(X.paged(lambda s, n: fake.short("A", "1m", s, n), fake.FIRST, None, "1m"))
    assert len(rows) == 721
    t = time.time()
    assert len(list(X.paged(lambda s, n: fake.stuck("A", "1m", s, n), fake.FIRST, None, "1m"))) == 1
    assert time.time() - t < 1


def test_retry():
    calls, pauses = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("429 too many requests")
        return ["ok"]

    assert X.with_retry(call, sleep=pauses.append) == ["ok"]
    assert len(pauses) == 2 and 0.5 <= pauses[0] <= 0.75 and 1 <= pauses[1] <= 1.5
    with pytest.raises(RuntimeError, match="invalid"):
        X.with_retry(lambda: fake.fetch("BAD/USD", "1m", 0, 1), sleep=pauses.append)
    assert not X.retryable(ValueError("invalid symbol")) and X.retryable(TimeoutError()) and X.retryable(RuntimeError("something went wrong"))


def test_bounded(spark):
    candles, errors = X.fetch(spark, "fake_exchange:fetch", ["A/USD"], ["1m"], **BOUNDS, pagesPerTask=1)
    assert candles.count() == 721 and errors.count() == 0


def test_open_ended(spark):
    candles, _ = X.fetch(spark, "fake_exchange:fetch", ["A/USD"], ["5m"], start="2024-01-01")
    assert candles.count() == 721


def test_bounds(spark):
    one = lambda **k: X.fetch(spark, "fake_exchange:fetch", ["A/USD"], ["1m"], **k)[0].count()
    assert one(start="2024-01-01T00:10:00", end="2024-01-01T00:12:30Z") == 3
    assert one(start="2024-01-01T10:00:00", end="2024-01-01") == 121  # midnight means the end of the day
    assert one(start="2024-01-02T00:00:00", end="2024-01-01T05:00:00") == 0


def test_failures_are_isolated(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    errors = X.fetch_and_save(spark, "fake_exchange:fetch", ["A/USD", "BAD/USD"], ["1m", "5m"], folder, **BOUNDS)
    assert {(r["symbol"], r["timeframe"]) for r in errors.collect()} == {("BAD/USD", "1m"), ("BAD/USD", "5m")}
    assert store.load(spark, folder, "a-usd", "1m").count() == 721
    with pytest.raises(Exception, match="invalid symbol"):
        X.fetch(spark, "fake_exchange:fetch", ["BAD/USD"], ["1m"], **BOUNDS)[0].count()


def test_refill(spark, tmp_path):
    candles, errors = X.fetch(spark, "fake_exchange:fetch", [f"FLAKY{tmp_path}"], ["1m"], **BOUNDS, pagesPerTask=1, tries=1)
    assert candles.count() == 721 and errors.count() == 0


class Temporary(Exception):
    pass


def test_error_classes():
    kinds = {n: type(n, (Exception,), {}) for n in ("NetworkError", "BadSymbol", "PermissionDenied")}
    below = type("InvalidNonce", (kinds["NetworkError"],), {})
    assert X.retryable(kinds["NetworkError"]("x")) and X.retryable(type("Own", (kinds["NetworkError"],), {})())
    assert not X.retryable(kinds["BadSymbol"]("service unavailable")) and not X.retryable(below("429")) and not X.retryable(Temporary("x"))


def test_pace():
    now, begun = [0.0], []
    pace = X.Pace(2.0, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for work in (0.5, 5.0, 0.0, 0.0, 3.0):
        pace.wait()
        begun.append(now[0])
        now[0] += work
    assert begun == [0.0, 2.0, 7.0, 9.0, 11.0]


def test_budget_is_shared(monkeypatch):
    """However many windows and tasks there are, requests of all tasks together keep to the budget, repeated ones included."""
    o = {"fetcher": "fake_exchange:fetch", "symbols": "A/USD,B/USD", "timeframes": "1m,5m", "start": BOUNDS["start"], "end": BOUNDS["end"], "pagespertask": "1", "budget": "10", "concurrency": "3"}
    reader = X._Reader(o)
    parts = reader.partitions()
    assert len(parts) == 3 and sum(len(p.windows) for p in parts) == len(reader.windows()) == 8
    times, starts = [], []
    for p in parts:  # at once on a cluster: each has its own clock here
        now, calls = [0.0], []
        monkeypatch.setattr(X.time, "monotonic", lambda: now[0])
        pace = X.Pace
        monkeypatch.setattr(X, "Pace", lambda pause, pace=pace: pace(pause, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s)))
        failed = set()

        def flaky(symbol, timeframe, since, limit):
            calls.append(now[0])
            if (symbol, timeframe, since) not in failed:
                failed.add((symbol, timeframe, since))
                raise TimeoutError
            return fake.fetch(symbol, timeframe, since, limit)

        monkeypatch.setattr(fake, "flaky", flaky, raising=False)
        rows = list(X._Reader(o | {"fetcher": "fake_exchange:flaky", "basepause": "0"}).read(p))
        monkeypatch.setattr(X, "Pace", pace)
        assert rows and [r[-1] for r in rows] == list(range(len(rows)))
        assert all(b - a >= 0.3 - 1e-9 for a, b in zip(calls, calls[1:], strict=False))
        times += calls
        starts.append(len(calls))
    for t in times:
        assert sum(t <= x < t + 1 - 1e-9 for x in times) <= 10 + 3


def test_latest(spark):
    known = spark.sql("SELECT 'A/USD' AS symbol, '1m' AS timeframe, timestamp_ntz'2024-01-01 12:00:00' AS timestamp")
    candles, errors = X.fetch_latest(spark, "fake_exchange:newest", ["A/USD", "BAD/USD"], ["1m"], 10, known, on_error="row")
    assert sorted(r["timestamp"].minute for r in candles.collect()) == list(range(51, 60)) and errors.count() == 1
    assert X.fetch_latest(spark, "fake_exchange:newest", ["A/USD"], ["1m"], 10)[0].count() == 10


def test_update_from_the_exchange(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    assert X.update(spark, folder, "fake_exchange:newest", "A/USD", "1m", 5).count() == 5
    got = X.update(spark, folder, "fake_exchange:newest", "A/USD", "1m", 8)
    assert got.count() == 8 and {r["symbol"] for r in got.collect()} == {"a-usd"}


def test_the_last_of_repeated_candles_stays(spark):
    assert [r["close"] for r in X.fetch(spark, "fake_exchange:twice", ["A/USD"], ["1m"], start="2024-01-01", end="2024-01-01T00:00:30")[0].collect()] == [9.0]


def test_ccxt_fetchers(monkeypatch):
    import sys
    import types

    from wickwork.sources import ccxt_exchange

    class Client:
        def __init__(self, config):
            self.config = config

        def fetch_ohlcv(self, symbol, timeframe, since, limit):
            return [[since or 7, 1, 2, 0, 1, 3], None, [None, 1, 1, 1, 1, 1]][:limit]

    monkeypatch.setitem(sys.modules, "ccxt", types.SimpleNamespace(someexchange=Client))
    fetch = ccxt_exchange.someexchange
    assert fetch("A/USD", "1m", None, 300) == [[7, 1, 2, 0, 1, 3]] and ccxt_exchange._client("someexchange").config["enableRateLimit"]
    with pytest.raises(ValueError, match="unknown timeframe"):
        fetch("A/USD", "7m", None, 300)
