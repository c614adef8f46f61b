"""A fetcher without a network: one-minute candles of 2024-01-01, with failures on demand."""

from pathlib import Path

FIRST = 1704067200000
CALLS = []


def fetch(symbol, timeframe, since, limit):
    if symbol == "BAD/USD":
        raise RuntimeError("invalid symbol")
    if symbol.startswith("FLAKY"):
        mark = Path(symbol.removeprefix("FLAKY")) / f"{since}"
        if not mark.exists():
            mark.touch()
            raise RuntimeError("503 Service Unavailable")
    step = {"1m": 60_000, "5m": 300_000}[timeframe]
    first = max(0, -(-(since - FIRST) // step))
    return [[FIRST + step * i, 1.0, 2.0, 0.5, 1.5, float(i)] for i in range(first, min(first + limit, 721))]


def stuck(symbol, timeframe, since, limit):
    return [[FIRST, 1.0, 2.0, 0.5, 1.5, 1.0]]


def short(symbol, timeframe, since, limit):
    return fetch(symbol, timeframe, since, 7)


def newest(symbol, timeframe, since, limit):
    assert since is None
    return fetch(symbol, timeframe, FIRST + (721 - limit) * 60_000, limit)


def twice(symbol, timeframe, since, limit):
    return [[FIRST, 1.0, 2.0, 0.5, c, 1.0] for c in (1.0, 9.0)]
