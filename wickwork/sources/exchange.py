"""Paged candle download as a Spark data source.

A fetcher is ``fetch(symbol, timeframe, since_ms, limit) -> list of [ts_ms, open, high, low, close, volume]``, named by the
option ``fetcher`` as ``module:function``; since_ms is None for the newest candles. Requests are symbols times timeframes. A bounded request is windows of
pages; an open-ended one is paged by a cursor; a request for the newest candles (``latest=true``) is one call. Each is a partition, unless there is a budget:
with ``budget`` (requests a second, over all tasks) they are dealt into ``concurrency`` partitions, each of which begins its requests,
repeated ones included, at least concurrency / budget seconds apart. So the rate holds however many tasks run at once.
Failures that look temporary are tried again with growing pauses; a window
that still fails gives an error row (``onError=row``) or fails the task (``onError=fail``), so nothing gets lost in silence.
"""

from __future__ import annotations

import importlib
import random
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wickwork.functions import schema as S
from wickwork.functions.timeframe import PAGE, bounds, naive_utc, seconds
from wickwork.sources.candles import from_rows

#: What messages of errors worth another try hold, in upper case.
RETRYABLE = (
    "UNAVAILABLE",
    "SOMETHING WENT WRONG",
    "INTERNAL SERVER ERROR",
    "SERVICE UNAVAILABLE",
    "TIMEOUT",
    "TOO MANY REQUESTS",
    "429",
    "5XX",
)
#: The names of the exchange library's error classes that are, and are not, worth another try.
TEMPORARY = ("RateLimitExceeded", "NetworkError", "ExchangeNotAvailable", "RequestTimeout", "DDoSProtection", "NullResponse")
PERMANENT = ("BadSymbol", "AuthenticationError", "PermissionDenied", "InvalidNonce")
MAX_OPEN_FAILURES = 5
SCHEMA = "symbol string, timeframe string, ts_ms long, open double, high double, low double, close double, volume double, error string, seq long"


def retryable(error: BaseException) -> bool:
    """Whether an error looks temporary: by its class, of which permanent ones go first, or by what it says. Classes are known by name, theirs or a base's."""
    kinds = {c.__name__ for c in type(error).__mro__}
    if kinds & {*PERMANENT}:
        return False
    text = str(error).upper()
    return bool(kinds & {*TEMPORARY}) or isinstance(error, (TimeoutError, ConnectionError)) or any(x in text for x in RETRYABLE)


def millis(moment: datetime) -> int:
    """A naive UTC moment in milliseconds since the epoch."""
    return (moment - datetime(1970, 1, 1)) // timedelta(milliseconds=1)  # noqa: DTZ001


def window_starts(start_ms: int, end_ms: int, timeframe: str, page: int = PAGE) -> list[int]:
    return list(range(start_ms, end_ms + 1, seconds(timeframe) * 1000 * page))


def with_retry(call: Callable[[], list], tries: int = 5, base_pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> list:
    for k in range(tries):
        try:
            return call()
        except Exception as e:
            if k == tries - 1 or not retryable(e):
                raise
            sleep(base_pause * 2**k * (1 + 0.5 * random.random()))
    return []


def paged(fetch: Callable[[int, int], list], since: int, until: int | None, timeframe: str, page: int = PAGE) -> Iterator[list]:
    """Candles from since to until (inclusive). A short page goes on; an empty one or one that doesn't advance ends it."""
    step = seconds(timeframe) * 1000
    while until is None or since <= until:
        rows = fetch(since, page)
        fresh = sorted(r for r in rows if r[0] >= since)
        if not fresh:
            return
        for r in fresh:
            if until is None or r[0] <= until:
                yield r
        since = fresh[-1][0] + step


class _Window:
    def __init__(self, symbol: str, timeframe: str, start: int | None, end: int | None):
        self.symbol, self.timeframe, self.start, self.end = symbol, timeframe, start, end


class _Windows(InputPartition):
    def __init__(self, windows: list[_Window]):
        self.windows = windows


class Pace:
    """Lets calls begin at least pause seconds apart."""

    def __init__(self, pause: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.pause, self.clock, self.sleep, self.next = pause, clock, sleep, None

    def wait(self) -> None:
        now = self.clock()
        if self.next is not None and now < self.next:
            self.sleep(self.next - now)
            now = max(self.next, self.clock())
        self.next = now + self.pause


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}

    def _list(self, name: str) -> list[str]:
        return [x.strip() for x in self.o.get(name, "").split(",") if x.strip()]

    def windows(self) -> list[_Window]:
        page, pages = int(self.o.get("page", PAGE)), int(self.o.get("pagespertask", "10"))
        out: list[_Window] = []
        for s in self._list("symbols"):
            for t in self._list("timeframes"):
                if self.o.get("latest") == "true":
                    out.append(_Window(s, t, None, None))
                    continue
                start = millis(naive_utc(self.o["start"])) if "start" in self.o else 0
                end = millis(bounds(None, self.o["end"], t)[1]) if "end" in self.o else None
                if end is None:
                    out.append(_Window(s, t, start, None))
                    continue
                span = seconds(t) * 1000 * page * pages
                out += [_Window(s, t, x, min(x + span - seconds(t) * 1000, end)) for x in window_starts(start, end, t, page * pages)]
        return out

    def partitions(self) -> list[InputPartition]:
        found = self.windows()
        many = int(self.o.get("concurrency", "8")) if "budget" in self.o else len(found)
        many = max(1, min(many, len(found)))
        return [_Windows(found[k::many]) for k in range(many)]  # a scan needs a partition, if an empty one

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.o["fetcher"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        pace = Pace(int(self.o.get("concurrency", "8")) / float(self.o["budget"]) if "budget" in self.o else 0.0)
        seq = 0
        for w in partition.windows:
            for row in self._window(fetch, w, pace):
                yield (*row, seq)
                seq += 1

    def _window(self, fetch: Callable, p: _Window, pace: Pace) -> Iterator[tuple]:
        page, tries, base = int(self.o.get("page", PAGE)), int(self.o.get("tries", "5")), float(self.o.get("basepause", "0.5"))

        def one(since: int | None, limit: int) -> list:
            def call() -> list:
                pace.wait()
                return fetch(p.symbol, p.timeframe, since, limit)

            return with_retry(call, tries, base)

        last, failures = p.start, 0
        while True:
            try:
                for r in one(None, int(self.o.get("limit", PAGE))) if p.start is None else paged(one, last, p.end, p.timeframe, page):
                    yield (p.symbol, p.timeframe, int(r[0]), *map(float, r[1:6]), None)
                    if p.start is not None:
                        last, failures = int(r[0]) + seconds(p.timeframe) * 1000, 0
                return
            except Exception as e:
                failures += 1
                if failures < (MAX_OPEN_FAILURES if p.end is None and p.start is not None else 2):
                    continue  # the refill: go on where it broke off
                if self.o.get("onerror", "fail") != "row":
                    raise
                yield (p.symbol, p.timeframe, None, None, None, None, None, None, str(e)[:500])
                return


class CandleSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "candles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def _requested(spark: SparkSession, fetcher: str, symbols: list[str], timeframes: list[str], budget_per_second: float | None, on_error: str, options: dict) -> tuple[DataFrame, DataFrame]:
    for t in timeframes:
        seconds(t)
    spark.dataSource.register(CandleSource)
    options = {k: str(v) for k, v in options.items() if v is not None}
    if budget_per_second:
        options = {"budget": str(budget_per_second), "concurrency": str(spark.sparkContext.defaultParallelism)} | options
    raw = spark.read.format("candles").options(fetcher=fetcher, symbols=",".join(symbols), timeframes=",".join(timeframes), onError=on_error, **options).load()
    good = raw.where("error is null")
    return S.keep_last(from_rows(good, "seq"), seq="seq").drop("seq"), raw.where(F.col("error").isNotNull()).select("symbol", "timeframe", "error")


def fetch(spark: SparkSession, fetcher: str, symbols: list[str], timeframes: list[str], start=None, end=None, budget_per_second: float | None = None, on_error: str = "fail", **options) -> tuple[DataFrame, DataFrame]:
    """(candles, errors) of all requests; of candles with one timestamp the last that came stays. budget_per_second bounds the requests of all tasks together."""
    return _requested(spark, fetcher, symbols, timeframes, budget_per_second, on_error, {"start": start, "end": end} | options)


def fetch_latest(spark: SparkSession, fetcher: str, symbols: list[str], timeframes: list[str], limit: int = PAGE, exclude: DataFrame | None = None, budget_per_second: float | None = None, on_error: str = "fail", **options) -> tuple[DataFrame, DataFrame]:
    """(candles, errors): the newest limit candles that the exchange has of each series, but those whose (symbol, timeframe, timestamp) stand in exclude, which may be large."""
    candles, errors = _requested(spark, fetcher, symbols, timeframes, budget_per_second, on_error, {"latest": "true", "limit": limit} | options)
    if exclude is not None:
        candles = candles.join(exclude.select(*S.KEYS, "timestamp"), [*S.KEYS, "timestamp"], "left_anti").select(*candles.columns)
    return candles, errors


def update(spark: SparkSession, data_dir: str, fetcher: str, symbol: str, timeframe: str, limit: int = PAGE, **options) -> DataFrame:
    """Asks the exchange for the newest candles, saves those that the store does not have, and returns the whole series."""
    from wickwork.sources import store

    known = store.load(spark, data_dir, symbol, timeframe).withColumn("symbol", F.lit(symbol))
    fresh, _ = fetch_latest(spark, fetcher, [symbol], [timeframe], limit, known, **options)
    store.save(fresh, data_dir)
    return store.load(spark, data_dir, symbol, timeframe)


def fetch_and_save(spark: SparkSession, fetcher: str, symbols: list[str], timeframes: list[str], data_dir: str, **options) -> DataFrame:
    """Downloads into the store, all series at once; returns the errors, one row per window that failed."""
    from wickwork.sources.store import save

    candles, errors = fetch(spark, fetcher, symbols, timeframes, on_error="row", **options)
    save(candles, data_dir)
    return errors
