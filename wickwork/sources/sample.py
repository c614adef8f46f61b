"""A fetcher without a network: candles by a rule, in short pages, for examples and the query catalogue."""

from __future__ import annotations

from wickwork.functions.timeframe import seconds


#: When this exchange stands still: 2024-02-01, in milliseconds.
NOW = 1_706_745_600_000


def fetch(symbol: str, timeframe: str, since: int | None, limit: int) -> list[list[float]]:
    """Candles whose prices follow from their number since the epoch, the newest before NOW if since is None; a symbol that begins with BAD is refused."""
    if symbol.startswith("BAD"):
        raise ValueError(f"unknown symbol {symbol}")
    step = seconds(timeframe) * 1000
    if since is None:
        return [[n * step, n % 97, n % 97 + 2, n % 97 - 1, n % 97 + 1, n % 13] for n in range(NOW // step - limit, NOW // step)]
    first = -(-since // step)
    return [[n * step, n % 97, n % 97 + 2, n % 97 - 1, n % 97 + 1, n % 13] for n in range(first, min(first + min(limit, 50), NOW // step))]


_ASKED: set[tuple] = set()


def flaky(symbol: str, timeframe: str, since: int | None, limit: int) -> list[list[float]]:
    """fetch, but a worker's first request for anything fails as if the exchange were busy."""
    if (symbol, timeframe, since) not in _ASKED:
        _ASKED.add((symbol, timeframe, since))
        raise TimeoutError("429 Too Many Requests")
    return fetch(symbol, timeframe, since, limit)
