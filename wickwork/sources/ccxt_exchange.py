"""Fetchers over the ccxt library, where it is installed: ``wickwork.sources.ccxt_exchange:NAME`` fetches from the exchange that ccxt calls NAME.

Keys come from the environment variables CCXT_API_KEY and CCXT_SECRET, if they are set. A client is made once per worker; its own
rate limit is on, beside the budget of ``exchange.fetch``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

from wickwork.functions.timeframe import seconds


@lru_cache
def _client(name: str):
    import ccxt

    keys = {"apiKey": os.environ.get("CCXT_API_KEY"), "secret": os.environ.get("CCXT_SECRET")}
    return getattr(ccxt, name)({"enableRateLimit": True} | ({k: v for k, v in keys.items() if v}))


def __getattr__(name: str) -> Callable:
    if name.startswith("_"):
        raise AttributeError(name)

    def fetch(symbol: str, timeframe: str, since: int | None, limit: int) -> list:
        """A page of at most limit candles from since on, or the newest ones; rows without a timestamp are left out."""
        seconds(timeframe)
        rows = _client(name).fetch_ohlcv(symbol, timeframe, since=since, limit=limit)
        return [r for r in rows or [] if r and r[0] is not None]

    return fetch
