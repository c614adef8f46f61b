"""Candles from event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions.timeframe import at_micros, seconds


def from_events(events: DataFrame, timeframe: str, symbol: str = "event_type", price: str = "value", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """OHLCV candles per symbol: price by time (ties by id), volume the number of events. One partial aggregate and one shuffle."""
    at = F.window(ts, f"{seconds(timeframe)} seconds")["start"]
    order = F.struct(ts, tie)
    return events.groupBy(F.col(symbol).alias("symbol"), at.alias("timestamp")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count("*").cast("double").alias("volume"),
    ).select("symbol", F.lit(timeframe).alias("timeframe"), "timestamp", "open", "high", "low", "close", "volume")


def from_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Raw exchange rows (symbol, timeframe, ts_ms and prices) with the candle schema, and more of their columns."""
    at = at_micros(F.col("ts_ms") * 1000)
    return rows.select("symbol", "timeframe", at.alias("timestamp"), *(F.col(c).cast("double") for c in ("open", "high", "low", "close", "volume")), *more)
